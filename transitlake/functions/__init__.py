"""Column functions; all stay inside the JVM.

Arguments are column names or SQL expressions as text, and each function makes
one parsed expression. Chaining ``Column`` objects instead costs a round trip to
the JVM per node, which adds up to seconds over a whole star schema.
"""
