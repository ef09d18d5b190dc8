"""Column-expression builders: everything here returns a ``Column`` that runs
JVM-side inside whole-stage codegen, except the explicitly marked Arrow UDFs."""
