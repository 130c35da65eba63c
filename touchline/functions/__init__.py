"""Column expressions: no actions, no UDFs, everything stays inside whole-stage codegen."""
