"""Text predicates and response parsing as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character a Unicode-aware strip removes.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

CODE_MARK = "CODE:"
TYPE_MARK = "BUG_TYPE:"
UNKNOWN_TYPE = "unknown"


def strip_unicode(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACE_CHARS))


def code_length(text: Column) -> Column:
    """Length in code points."""
    return F.length(text)


def has_min_length(text: Column, minimum: int = 50) -> Column:
    return F.coalesce(F.length(strip_unicode(text)) >= minimum, F.lit(False))


def has_function(text: Column) -> Column:
    return F.coalesce(F.contains(text, F.lit("def ")), F.lit(False))


def has_docstring(text: Column) -> Column:
    quoted = F.contains(text, F.lit('"""')) | F.contains(text, F.lit("'''"))
    return F.coalesce(quoted, F.lit(False))


def drop_fences(text: Column) -> Column:
    """Remove Markdown code fences, then strip."""
    bare = F.replace(F.replace(text, F.lit("```python"), F.lit("")), F.lit("```"), F.lit(""))
    return strip_unicode(bare)


def response_code(response: Column) -> Column:
    """Code part of a response: between the code marker and the type marker, fences removed."""
    section = F.split_part(response, F.lit(CODE_MARK), F.lit(2))
    code = F.split_part(section, F.lit(TYPE_MARK), F.lit(1))
    return drop_fences(F.when(F.contains(response, F.lit(CODE_MARK)), code).otherwise(response))


def response_type(response: Column) -> Column:
    """Bug type named after the code part, ``unknown`` where there is none."""
    section = F.split_part(response, F.lit(CODE_MARK), F.lit(2))
    named = strip_unicode(F.split_part(section, F.lit(TYPE_MARK), F.lit(2)))
    found = F.contains(response, F.lit(CODE_MARK)) & F.contains(section, F.lit(TYPE_MARK))
    return F.when(found, named).when(response.isNotNull(), F.lit(UNKNOWN_TYPE))


def fill_template(template: str, **values: Column) -> Column:
    """Replace each ``{name}`` of a fixed template by the column given for it."""
    pieces = re.split(r"\{(\w+)\}", template)
    columns = [F.lit(p) if i % 2 == 0 else values[p].cast("string") for i, p in enumerate(pieces)]
    return F.concat(*columns)
