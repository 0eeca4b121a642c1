"""Column functions (pure JVM expressions, usable inside whole-stage codegen)."""
