"""Column expressions: no UDFs. Those that walk arrays or maps run outside whole-stage codegen."""
