"""From a pair of status lists to the kind of change it was.

A status list is reduced to one *state*: published, published with a pending draft, draft,
closed, or none of these. The kind then is a lookup of (event type, old state, new state) in
a constant map.
"""

from itertools import chain, product

from pyspark.sql import Column, functions as F

from slugline.schema import CLOSED, DELETE, DRAFT, EDIT, NEW, PUBLISH

PENDING = "PUBLISH+DRAFT"
UNCLEAR = "-"

_LIVE = (PUBLISH, PENDING)

# Every recognised transition; anything else has no kind. Publishing from nothing
# known includes lists that cannot be read as one state, not just absent ones.
_TRANSITIONS = (
    (NEW, (UNCLEAR,), (DRAFT,), "INITIAL_DRAFT"),
    (NEW, (UNCLEAR,), _LIVE, "INITIAL_PUBLISH"),
    (EDIT, (DRAFT,), (DRAFT,), "SAVE_DRAFT"),
    (EDIT, (DRAFT,), _LIVE, "PUBLISH_FROM_DRAFT"),
    (EDIT, (PUBLISH,), (PUBLISH,), "UPDATE_PUBLISHED"),
    (EDIT, (PENDING,), (PENDING,), "UPDATE_PUBLISHED"),
    (EDIT, (PUBLISH,), (PENDING,), "ADD_DRAFT_TO_PUBLISHED"),
    (EDIT, (PENDING,), (PUBLISH,), "DISCARD_DRAFT_ON_PUBLISHED"),
    (EDIT, _LIVE, (DRAFT,), "UNPUBLISH_TO_DRAFT"),
    (EDIT, _LIVE, (CLOSED,), "UNPUBLISH_TO_CLOSED"),
    (EDIT, (CLOSED,), (DRAFT,), "REOPEN_TO_DRAFT"),
    (EDIT, (CLOSED,), _LIVE, "REPUBLISH_FROM_CLOSED"),
    (DELETE, (DRAFT,), (UNCLEAR,), "DELETE_DRAFT"),
    (DELETE, _LIVE, (UNCLEAR,), "DELETE_PUBLISHED"),
    (DELETE, (CLOSED,), (UNCLEAR,), "DELETE_CLOSED"),
)

KIND_BY_CHANGE = {
    f"{event_type}>{old}>{new}": kind
    for event_type, olds, news, kind in _TRANSITIONS
    for old, new in product(olds, news)
}


def content_state(statuses: Column) -> Column:
    """One state for a de-duplicated status list; draft and closed count only when alone."""
    published = F.array_contains(statuses, PUBLISH)
    alone = F.when(F.size(statuses) == 1, F.get(statuses, F.lit(0)))
    return (
        F.when(published & F.array_contains(statuses, DRAFT), PENDING)
        .when(published, PUBLISH)
        .when(alone.isin(DRAFT, CLOSED), alone)
        .otherwise(UNCLEAR)
    )


def event_kind(event_type: Column, old_statuses: Column, new_statuses: Column) -> Column:
    """The kind of change, NULL where the transition is not a recognised one."""
    change = F.concat_ws(
        ">", F.coalesce(event_type, F.lit("")), content_state(old_statuses), content_state(new_statuses)
    )
    kinds = F.create_map(*[F.lit(text) for text in chain.from_iterable(KIND_BY_CHANGE.items())])
    return F.try_element_at(kinds, change)
