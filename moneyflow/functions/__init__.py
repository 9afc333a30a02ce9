"""Column expressions of the domain; pure functions from Column to Column, all inside whole-stage codegen."""
