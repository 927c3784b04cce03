"""Column-name clean-up and repair of rule texts (metadata only, no rows)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame

# A quoted string (left alone), or a comparison with a bare word after it.
_BARE = re.compile(
    r"'(?:[^']|'')*'"
    r'|"[^"]*"'
    r"|(?P<left>[A-Za-z_]\w*)?(?P<op>\s*(?:<>|!=|(?<![<>!])==?)\s*)(?P<word>[A-Za-z_]\w*)\b(?!\s*[.(])"
)
_KEYWORDS = {
    "true", "false", "null", "case", "cast", "date", "timestamp", "interval", "not",
    "current_date", "current_timestamp", "current_user",
}


def normalize_names(df: DataFrame, lower: bool = True) -> DataFrame:
    """Replace blanks in column names by ``_``, by default in lower case."""
    names = [c.replace(" ", "_") for c in df.columns]
    if lower:
        names = [n.lower() for n in names]
    clashes = sorted({n for n in names if sum(n.lower() == m.lower() for m in names) > 1})
    if clashes:
        raise ValueError(f"columns share a name after clean-up: {clashes}")
    return df.toDF(*names)


def quote_bare_words(
    condition: str,
    columns: Iterable[str],
    texts: Iterable[str] | None = None,
    words: Iterable[str] | None = None,
) -> str:
    """Quote words compared with ``=`` that are neither columns nor keywords:
    ``Promotion_Type = Bulk`` becomes ``Promotion_Type = 'Bulk'``.

    ``texts`` names the string columns; a bare word next to anything else is an error.
    ``words`` lists the words that may be quoted, any if it is not given.
    """
    known = {c.lower() for c in columns} | _KEYWORDS
    strings = None if texts is None else {c.lower() for c in texts}
    allowed = None if words is None else set(words)

    def fix(match: re.Match) -> str:
        word = match.group("word")
        if word is None or word.lower() in known:
            return match.group(0)
        left = match.group("left") or ""
        if strings is not None and left.lower() not in strings:
            raise ValueError(f"{word!r} in {condition!r} is neither a column nor compared with a text column")
        if allowed is not None and word not in allowed:
            raise ValueError(f"{word!r} in {condition!r} is no known word")
        return f"{left}{match.group('op')}'{word}'"

    return _BARE.sub(fix, condition)
