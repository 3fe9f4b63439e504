"""SQL expressions, given and returned as text.

They are used through ``F.expr`` and ``selectExpr``. All are built-in functions, so they stay inside
generated code; as text, a wide expression reaches Spark in one call.
"""
