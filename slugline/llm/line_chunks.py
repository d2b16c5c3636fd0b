"""Line dedup by content-defined chunks of lines, in DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from slugline.llm.common import WORD_PATTERN, written

LONG_WORDS = 50
ONE_IN = 2
# The rolling hash weighs the line before by this, so the order of two lines counts.
WEIGHT = 31
# Places of one chunk meet its first place in as many tasks as this.
SALTS = 64
# Lines and words in one number, and the lines that are tried before all that could be needed.
STEP = 1 << 32
FEW = 8


def line_hash(line: Column) -> Column:
    """The first 32 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def words_in(line: Column) -> Column:
    return F.regexp_count(line, F.lit(WORD_PATTERN))


def once(value: Column, use) -> Column:
    """`use` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def chunks(text: Column, long_words: int, one_in: int) -> Column:
    """What may go from a text: array of (start, n_lines, chunk).

    A chunk ends with line i when the rolling hash of lines i - 1 and i is divisible by
    `one_in`, when line i or the next has `long_words` words, and at the end of the text. So an
    inserted line moves the borders next to it alone, and a passage of one long line is a chunk
    of its own. Chunks of two lines with a word in them may go, and long lines.

    A passage of a few lines can lie across the borders that its surroundings give it. So a
    further chunk starts at every shorter line with a word and ends with the line that completes
    `long_words` words, unless a long line comes first: both its borders depend on its lines alone.
    """
    lines = F.split(text, "\n", -1)
    facts = F.transform(lines, lambda x: F.struct(line_hash(x).alias("hash"), words_in(x).alias("words")))

    def chunk(of: Column, start: Column, stop: Column) -> Column:
        size = stop - start + 1
        body = F.array_join(F.slice(of["lines"], start + 1, size), "\n")
        return F.struct(start.alias("start"), size.alias("n_lines"), body.alias("chunk"))

    def borders(of: Column) -> Column:
        n = F.size(of["facts"])

        def ends(fact: Column, i: Column) -> Column:
            before = F.when(i > 0, F.get(of["facts"], i - 1)["hash"]).otherwise(F.lit(0))
            following = F.coalesce(F.get(of["facts"], i + 1)["words"], F.lit(0))
            rolled = F.pmod(fact["hash"] + before * WEIGHT, F.lit(one_in)) == 0
            at_end = (i == n - 1) | rolled | (fact["words"] >= long_words) | (following >= long_words)
            return F.struct(i.alias("stop"), at_end.alias("at_end"))

        return F.transform(F.filter(F.transform(of["facts"], ends), lambda e: e["at_end"]), lambda e: e["stop"])

    def cut(of: Column) -> Column:
        def one(stop: Column, k: Column) -> Column:
            start = F.when(k > 0, F.get(of["stops"], k - 1) + 1).otherwise(F.lit(0))
            size = stop - start + 1
            words = F.aggregate(
                F.slice(of["facts"], start + 1, size), F.lit(0), lambda total, fact: total + fact["words"]
            )
            goes = (words >= long_words) | ((size >= 2) & (words > 0))
            return F.when(goes, chunk(of, start, stop))

        return F.transform(of["stops"], one)

    def from_each_line(of: Column) -> Column:
        with_line = F.transform(of["facts"], lambda f, i: F.struct(i.alias("line"), f["words"].alias("words")))

        def starts(told: Column) -> Column:
            def reach(k: Column, most: int) -> Column:
                """STEP times the lines read until `long_words` words are complete, plus those words."""
                return F.aggregate(
                    F.slice(told, k + 1, most),
                    F.lit(0).cast("long"),
                    lambda sofar, x: F.when(sofar % STEP < long_words, sofar + x["words"] + STEP).otherwise(sofar),
                )

            def one(first: Column, k: Column) -> Column:
                def ended(reached: Column) -> Column:
                    last = F.get(told, k + F.floor(reached / STEP).cast("int") - 1)
                    whole = (reached % STEP >= long_words) & (last["words"] < long_words)
                    return F.when(whole, chunk(of, first["line"], last["line"]))

                # Most passages are complete in a few lines; no more than `long_words` can be needed.
                few = once(reach(k, FEW), lambda r: F.when(r % STEP >= long_words, r).otherwise(reach(k, long_words)))
                return F.when(first["words"] < long_words, once(few, ended))

            return F.transform(told, one)

        return once(F.filter(with_line, lambda x: x["words"] > 0), starts)

    def both(of: Column) -> Column:
        return F.filter(F.concat(cut(of), from_each_line(of)), lambda c: c.isNotNull())

    def bordered(of: Column) -> Column:
        return once(F.struct(of["lines"].alias("lines"), of["facts"].alias("facts"), borders(of).alias("stops")), both)

    return once(F.struct(lines.alias("lines"), facts.alias("facts")), bordered)


def remove_repeated_chunks(docs: DataFrame, long_words: int = LONG_WORDS, one_in: int = ONE_IN) -> DataFrame:
    """`docs` (doc_id, text, ...) in a struct `row`, with text and n_removed, its lines that went.

    Of equal chunks anywhere in the table, the one of the smallest (doc_id, hash of the text, start) stays; the
    lines of the others go with their ends. The first place of a line in the table is in no
    chunk that goes, so nothing is lost altogether. Hashes only preselect: chunks are equal when
    all their bytes are. Rows of the same doc_id and text are one document: they keep and lose the
    same; rows of the same doc_id and other texts, null ids too, are others. A null doc_id comes first. Null texts stay null with no chunk; an empty text is one
    line, kept; an empty table gives an empty one. Columns and their names don't matter.

    Only hashes of chunks are shuffled first, then the chunks whose hash is repeated, aggregated
    before the shuffle, so a passage that a third of the documents share is no hot key; its places
    meet the first one in `SALTS` tasks; texts meet the list of what they lose in one join, by document.
    """
    texts = docs.where("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    cut = texts.select("doc_id", "text_key", F.explode(chunks(F.col("text"), long_words, one_in)).alias("c"))
    candidates = cut.select("doc_id", "text_key", "c.*").withColumn("key", F.xxhash64("chunk"))
    places = candidates.select("key", "doc_id", "start", "text_key")
    # Two places at least: the smallest and the largest differ.
    place = F.struct("doc_id", "text_key", "start")
    again = written(
        places.groupBy("key").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("NOT (a <=> b)").select("key"),
        "repeated_keys",
    )
    # The same plan at every size: keys and chunks are sorted and merged, never broadcast.
    salt = F.pmod(F.xxhash64("doc_id", "text_key", "start"), F.lit(SALTS))
    shared = written(
        candidates.join(again.hint("merge"), "key", "left_semi").withColumn("salt", salt), "repeated_chunks"
    )
    firsts = (
        shared.groupBy("key", "chunk")
        .agg(F.min(place).alias("first"), F.collect_set("salt").alias("salts"))
        .select("key", "chunk", "first", F.explode("salts").alias("salt"))
    )
    lost = (
        shared.join(firsts.hint("merge"), ["key", "chunk", "salt"])
        .where(~place.eqNullSafe(F.col("first")))
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("start", "n_lines")).alias("lost"))
        .withColumnsRenamed({"doc_id": "lost_id", "text_key": "lost_key"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("lost_id")) & (F.col("text_key") == F.col("lost_key"))
    # The text travels once, inside its row.
    whole = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row")["doc_id"].alias("doc_id"), F.xxhash64(F.col("row")["text"]).alias("text_key")
    )
    joined = whole.join(lost.hint("shuffle_hash"), same, "left")

    text = F.col("row")["text"]

    def kept(lines: Column) -> Column:
        gone = F.flatten(F.transform("lost", lambda c: F.sequence(c["start"], c["start"] + c["n_lines"] - 1)))
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.struct(
            F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n").alias("text"),
            (F.size(lines) - F.size(stay)).alias("n_removed"),
        )

    told = joined.withColumn("kept", F.when(F.col("lost").isNotNull(), once(F.split(text, "\n", -1), kept)))
    return told.select(
        "row",
        F.coalesce(F.col("kept")["text"], text).alias("text"),
        F.coalesce(F.col("kept")["n_removed"], F.lit(0)).alias("n_removed"),
    )


SQL = f"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS i
  FROM documents WHERE text IS NOT NULL
), facts AS (
  SELECT doc_id, text, line, i, ('0x' || substr(md5(line), 1, 8))::BIGINT AS hash,
         len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM lines
), marked AS (
  SELECT *, i = max(i) OVER (PARTITION BY doc_id)
            OR (hash + {WEIGHT} * coalesce(lag(hash) OVER w, 0)) % {ONE_IN} = 0
            OR words >= {LONG_WORDS} OR coalesce(lead(words) OVER w, 0) >= {LONG_WORDS} AS stops
  FROM facts WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT *, coalesce(sum(stops::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk_no
  FROM marked
), chunked AS (
  SELECT doc_id, min(i) AS start, max(i) AS stop, string_agg(line, chr(10) ORDER BY i) AS chunk
  FROM numbered GROUP BY doc_id, chunk_no
  HAVING sum(words) >= {LONG_WORDS} OR (count(*) >= 2 AND sum(words) > 0)
), summed AS (
  SELECT doc_id, text, i, words, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS total,
         sum((words >= {LONG_WORDS})::INT) OVER (PARTITION BY doc_id ORDER BY i) AS long_lines
  FROM facts WHERE words > 0
), starts AS (
  SELECT *, (total - words + {LONG_WORDS})::BIGINT AS wanted FROM summed WHERE words < {LONG_WORDS}
), from_each_line AS (
  SELECT s.doc_id, s.i AS start, e.i AS stop,
         array_to_string(list_slice(string_split(s.text, chr(10)), s.i + 1, e.i + 1), chr(10)) AS chunk
  FROM starts s ASOF JOIN summed e ON s.doc_id = e.doc_id AND s.wanted <= e.total
  WHERE s.long_lines = e.long_lines
), judged AS (
  SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, start) > 1 AS lost
  FROM (SELECT * FROM chunked UNION SELECT * FROM from_each_line)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(start, stop + 1)) AS i FROM judged WHERE lost
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (gone.i IS NULL), '') AS text,
       count(gone.i)::INT AS n_removed
FROM lines LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id
UNION ALL SELECT doc_id, NULL, 0 FROM documents WHERE text IS NULL
"""
