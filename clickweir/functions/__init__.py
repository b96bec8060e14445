"""Column functions; all stay inside whole-stage codegen."""
