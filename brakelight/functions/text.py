"""Text column expressions: quote stripping, link defanging, names, summaries.

All functions take and return ``Column`` objects and stay JVM-side (regex,
``split``/``regexp_extract_all`` and higher-order array functions), so they run
inside the scan stage without a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import DOC_PREFIX, NO_DESCRIPTION, PIPE_SEP
from .sql import string_lit

# The characters Python's str.strip()/str.isspace() treat as
# whitespace, written as a regex class body that both Java and RE2 accept.
WS_CLASS = (r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS_CHARS = ("\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b)))
            + "\u2028\u2029\u202f\u205f\u3000")
NONBLANK_RX = "[^" + WS_CLASS + "]"
EDGE_WS_RX = "^[" + WS_CLASS + "]+|[" + WS_CLASS + "]+$"

# Link patterns of the defang rule (case-insensitive).
MD_LINK_RX = r"(?i)\[([^\]]+)\]\((https?://[^\)]+)\)"
BARE_URL_RX = (r"(?i)(https?://[^" + WS_CLASS + r"<>\"'\)\]]+|www\.[^" + WS_CLASS
               + r"<>\"'\)\]]+)")
LINK_HINT_RX = r"(?i)https?://|www\."


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Trim the whitespace Python's ``str.strip`` removes (not only spaces)."""
    return F.btrim(col_(c).cast("string"), F.lit(WS_CHARS))


def strip_ws_sql(x: str) -> str:
    """SQL-text form of ``strip_ws`` for wide projections (``x`` is SQL text)."""
    return f"regexp_replace({x}, {string_lit(EDGE_WS_RX)}, '')"


def is_blank(c) -> Column:
    """True when the value holds no non-whitespace character; null stays null."""
    return ~col_(c).rlike(NONBLANK_RX)


def strip_quotes(c) -> Column:
    """Remove every double quote character."""
    return F.replace(col_(c), F.lit('"'), F.lit(""))


def defang_url(u: Column) -> Column:
    """A leading lower-case ``http`` becomes ``hxxp``; every ``.`` becomes ``[.]``."""
    return F.replace(F.regexp_replace(u, "^http", "hxxp"), F.lit("."), F.lit("[.]"))


def _rewrite_matches(text: Column, pattern: str, build, groups: int = 1) -> Column:
    """Replace every match of ``pattern`` by ``build(group1, group2)``.

    The text is cut at the matches with ``split`` (n matches -> n+1 pieces,
    trailing empties kept) and the rewritten matches are put back between the
    pieces with ``zip_with`` + ``array_join``; no Python involved. The arrays
    are arguments of the higher-order functions, so each is computed once per
    row (an expression referenced inside a lambda would be re-evaluated per
    element).
    """
    rx = F.lit(pattern)
    pieces = F.split(text, pattern, -1)
    g1 = F.regexp_extract_all(text, rx, F.lit(1))
    if groups > 1:
        g2 = F.regexp_extract_all(text, rx, F.lit(2))
        matches = F.zip_with(g1, g2, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        rebuilt = F.zip_with(matches, F.slice(pieces, 2, F.size(pieces)),
                             lambda m, p: F.concat(build(m["a"], m["b"]), p))
    else:
        rebuilt = F.zip_with(g1, F.slice(pieces, 2, F.size(pieces)), lambda m, p: F.concat(build(m, None), p))
    return F.concat(F.element_at(pieces, 1), F.array_join(rebuilt, ""))


def defang_links(c) -> Column:
    """Defang Markdown links first (``[t](u)`` -> ``t (u')``), then bare links.

    One pass, as the source rule: text already defanged is not guarded here
    (see ``defang_links_once`` for the report path).
    """
    text = col_(c)
    md = _rewrite_matches(text, MD_LINK_RX,
                          lambda label, url: F.concat(label, F.lit(" ("), defang_url(url), F.lit(")")),
                          groups=2)
    both = _rewrite_matches(md, BARE_URL_RX, lambda m, _: defang_url(m))
    # Rows without any link hint skip the regex work entirely.
    return F.when(text.rlike(LINK_HINT_RX), both).otherwise(text)


def defang_links_once(c) -> Column:
    """Report-path variant: text that already carries ``[.]`` is left alone."""
    text = col_(c)
    return F.when(F.contains(text, F.lit("[.]")), text).otherwise(defang_links(text))


def canonical_name(c) -> Column:
    """Trim, upper-case, each space -> ``_``."""
    return F.replace(F.upper(strip_ws(c)), F.lit(" "), F.lit("_"))


# The sentence summary template pieces.
SENTENCE_PARTS = ("a ", " model ", " produced in ", " was ", " with detail: ")


def summary_sentence(make="maketxt", model="modeltxt", year="yeartxt",
                     comp="compdesc", detail="cdescr") -> Column:
    """``a MAKE model MODEL produced in YEAR was COMPDESC with detail: CDESCR``; null if any part is null."""
    p = SENTENCE_PARTS
    return F.concat(F.lit(p[0]), col_(make), F.lit(p[1]), col_(model), F.lit(p[2]), col_(year),
                    F.lit(p[3]), col_(comp), F.lit(p[4]), col_(detail))


def summary_pipe(cols) -> Column:
    """Non-blank values of ``cols`` joined by `` | `` (null and blank skipped)."""
    return F.concat_ws(PIPE_SEP, *[F.when(col_(c).rlike(NONBLANK_RX), col_(c)) for c in cols])


def with_fallback(summary: Column, placeholder: str = NO_DESCRIPTION) -> Column:
    """Blank summary -> placeholder."""
    return F.when(F.coalesce(is_blank(summary), F.lit(True)), F.lit(placeholder)).otherwise(summary)


def task_prefix(c, prefix: str = DOC_PREFIX) -> Column:
    """Embedding-model task prefix; null text becomes the bare prefix."""
    return F.concat(F.lit(prefix), F.coalesce(col_(c), F.lit("")))


def or_default(c, default: str = "N/A") -> Column:
    """``x or default``: null or empty string -> default."""
    return F.coalesce(F.nullif(col_(c), F.lit("")), F.lit(default))


def py_str(c) -> Column:
    """Python ``str()`` of an optional string: null renders as ``None``."""
    return F.coalesce(col_(c), F.lit("None"))


def fixed2(score) -> Column:
    """Two-decimal text of a score (rounded to 6 first, then half-up to 2)."""
    x = col_(score)
    r = F.round(F.round(x, 6).cast("decimal(20,6)"), 2).cast("decimal(20,2)")
    # Python prints a small negative value as -0.00
    return F.when((x < 0) & (r == 0), F.lit("-0.00")).otherwise(r.cast("string"))
