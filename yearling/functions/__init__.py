"""SQL expression builders.

Every helper takes and gives SQL text for `expr`, `selectExpr` or `agg(expr(..))`:
one parsed text is far cheaper to build than a tree of Column calls.
"""
