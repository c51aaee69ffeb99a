"""What a user's expression text may do: one value per row, from that row alone."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Analysed expression classes that reach other rows, tables or the JVM.
_REFUSED = ("ScalarSubquery", "Exists", "InSubquery", "ListQuery", "LateralSubquery", "WindowExpression", "CallMethodViaReflection",
            "TryReflect", "AggregateExpression", "PythonUDF")


def require_plain(before: DataFrame, after: DataFrame) -> None:
    """``after`` is ``before`` with one more projection or filter. Looks at the
    analysed plan, not at the text: a generator or a window puts a plan node of
    its own below the top one, and subqueries and reflection are expressions."""
    top = after._jdf.queryExecution().analyzed()
    if not top.children().head().equals(before._jdf.queryExecution().analyzed()):
        raise ValueError("An expression must give one value per row: generators and windows are not allowed.")
    todo = [top.expressions()]
    while todo:
        found = todo.pop()
        for i in range(found.size()):
            e = found.apply(i)
            if e.getClass().getSimpleName() in _REFUSED:
                raise ValueError(f"Not allowed in an expression: {e.getClass().getSimpleName()}")
            todo.append(e.children())
