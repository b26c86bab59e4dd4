"""Scalar column functions (all JVM-side built-ins, no Python per row)."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def message_key(title: str | Column) -> Column:
    """Lower case, then replace the *literal* text ``s+`` with ``-``.

    The producer calls ``str.replace`` with a pattern-looking argument, which
    is a plain substring replace, so spaces survive: ``Sales+ Boss`` gives
    ``sale- boss``."""
    return F.replace(F.lower(_c(title)), F.lit("s+"), F.lit("-"))


# A word for title casing is a run of cased characters (the Unicode
# Lowercase or Uppercase property, or title case letters); every other
# character separates words.
CASED_RUN = r"([\p{IsLowercase}\p{IsUppercase}\p{Lt}]+|[^\p{IsLowercase}\p{IsUppercase}\p{Lt}]+)"


@lru_cache(maxsize=1)
def title_exceptions() -> dict[str, str]:
    """Characters whose title case is not their upper case (``ß`` -> ``Ss``,
    ligatures, digraphs), derived from Python's Unicode tables."""
    out = {}
    for i in range(0x110000):
        c = chr(i)
        t = c.title()
        if t != c.upper() or len(t) > 1:
            out[c] = t
    return out


def _multi_char_titles() -> dict[str, str]:
    """The exceptions whose title case is more than one character; a
    single-character title case is what ``initcap`` gives."""
    return {c: t for c, t in title_exceptions().items() if len(t) > 1}


def title_case(s: str | Column) -> Column:
    """The producer's ``str.title``: first character of every cased run
    in title case, the rest lower case.

    ``initcap`` splits words on spaces only (``o-b`` stays ``O-b``) and keeps
    ``ß``; here runs are split by the regex above, the first character is
    title-cased by ``initcap``, and only a character whose upper case is
    longer than one character (``ß``, ligatures) is looked up in the
    multi-character title table."""
    runs = F.regexp_extract_all(_c(s), F.lit(CASED_RUN), 1)
    special = F.create_map(*[F.lit(x) for kv in _multi_char_titles().items() for x in kv])

    def word(r: Column) -> Column:
        head = F.substring(r, 1, 1)
        titled = F.when(F.length(F.upper(head)) > 1,
                        F.coalesce(F.try_element_at(special, head), F.initcap(head))
                        ).otherwise(F.initcap(head))
        return F.concat(titled, F.lower(F.substring(r, 2, 1 << 30)))
    return F.array_join(F.transform(runs, word), "")


def utf8_or_null(b: str | Column) -> Column:
    """C3 strict decode that routes instead of failing: the string when the
    bytes are valid UTF-8, else null."""
    as_text = _c(b).cast("string")
    return F.when(F.call_function("is_valid_utf8", as_text), as_text)


def md5_pick(seed: str, id_col: str | Column, n: int) -> Column:
    """Deterministic pick in [0, n) that DuckDB can repeat:
    first 32 bits of md5(seed || ':' || id) modulo n."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), _c(id_col).cast("string")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % F.lit(n)).cast("int")


def md5_uuid(seed: str, id_col: str | Column) -> Column:
    """P3 test form: an id shaped like a UUID, from md5(seed || ':' || id)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), _c(id_col).cast("string")))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4),
                       F.substring(h, 13, 4), F.substring(h, 17, 4),
                       F.substring(h, 21, 12))


def record_id(method: str = "uuid", seed: str = "id",
              id_col: str | Column | None = None) -> Column:
    """A unique string id per record. ``uuid`` is random (Spark's
    ``uuid()``; a recomputed task draws new ones, so persist or write the
    result before reusing it); ``md5`` is the repeatable test form built
    from ``id_col``."""
    if method == "uuid":
        return F.expr("uuid()")
    if method == "md5":
        if id_col is None:
            raise ValueError("the md5 form needs id_col")
        return md5_uuid(seed, id_col)
    raise ValueError(f"unknown id method: {method}")
