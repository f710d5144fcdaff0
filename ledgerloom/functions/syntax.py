"""Python syntax check: the one per-row Python function, sent to workers in Arrow batches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _make_check():
    # Nested so that it is shipped by value and executors need no copy of this package.
    def parses(code) -> bool:
        import ast
        import warnings

        if code is None:
            return False
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                ast.parse(code)
            return True
        except Exception:
            return False

    def check(batches):
        for batch in batches:
            yield batch.map(parses).astype(bool)

    return check


def is_valid_python(text: Column) -> Column:
    """True where the text parses as Python; NULL and every parser failure are false.

    The answer is that of the Python version the workers run.
    """
    from collections.abc import Iterator

    import pandas as pd

    check = _make_check()
    check.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(check, returnType=T.BooleanType())(text)
