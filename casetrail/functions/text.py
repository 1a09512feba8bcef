"""Text predicates and the entry-meta parser.

All of it is built from Spark's regex and string functions, so it runs
inside the JVM and splits with the data.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the upstream warehouse for identical results).
# Entry type given to the registration entry built from a case header.
REGISTER_TYPE = "新規登録"
# Synthesised closing entry for cases closed without a closing entry.
DIRECT_CLOSE_TYPE = "完了へ直接変更"
DIRECT_CLOSE_BY = "(dummy)"
DIRECT_CLOSE_TEXT = "(ライブラリ変更などによりステータスを直接完了に変更)"
# Library-change marker: both substrings must occur in the description.
LIBRARY_MARK = "★★★★★★★★★★★★★★★★★★★"
LIBRARY_PHRASE = "ライブラリの変更が完了しました"
# Force-close announcement and force-close wording (unanchored, case-sensitive).
FORCE_CLOSE_ANNOUNCE_PATTERN = "その後[の]?状況.*(連絡|回答)が[な無](ければ|い場合).*クローズ"
FORCE_CLOSE_PATTERN = (
    "(連絡.*(なか|ない|無|ありま).*クローズ.*新規(ＱＡ|QA)登録を)|(強制クローズ[と]?させていただきます.*新規(ＱＡ|QA).*登録)"
)
# Meta suffix that closes an entry line: "(type:user yyyy/m/d)" at the end.
META_PATTERN = r"\([^:\(\)]+?:[^:]+ [0-9]{4}\/[0-9]{1,2}/[0-9]{1,2}\)$"
# Line boundaries of Python's str.splitlines: \r\n, \n, \r, \v, \f, \x1c, \x1d,
# \x1e, \x85, U+2028, U+2029.
LINE_SPLIT_PATTERN = "\r\n|[\n\r\u000b\u000c\u001c\u001d\u001e\u0085  ]"
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def matches(c, pattern: str) -> Column:
    """regex match where '.' also matches a newline; NULL text -> false."""
    return F.coalesce(_c(c).rlike("(?s)" + pattern), F.lit(False))


def is_force_close_announce(c) -> Column:
    return matches(c, FORCE_CLOSE_ANNOUNCE_PATTERN)


def is_force_close(c) -> Column:
    return matches(c, FORCE_CLOSE_PATTERN)


def has_library_change(description) -> Column:
    """P5/F16: both markers present; NULL description -> false."""
    d = _c(description)
    return F.coalesce(d.contains(LIBRARY_MARK) & d.contains(LIBRARY_PHRASE), F.lit(False))


def meta_of(line) -> Column:
    """The meta suffix of a line, '' when the line carries none."""
    return F.regexp_extract(_c(line), META_PATTERN, 0)


def parse_meta(line) -> Column:
    """struct<date, type, user, text> from one closing line.

    The date is the ten characters before the final ')', the type runs up to
    the first ':', the user is what lies between at fixed width (so a user may
    hold ')'), the text is the line without the meta suffix.  A short date
    such as 2023/1/5 is cut at ten characters like the upstream builder does.
    Lines without a meta suffix give an all-NULL struct.
    """
    line = _c(line)
    m = meta_of(line)
    return F.when(F.length(m) > 0, F.struct(*[v.alias(k) for k, v in meta_parts(line, m).items()]))


def meta_parts(line: Column, meta: Column) -> dict[str, Column]:
    """What a closing line and its meta suffix say."""
    n = F.length(meta)
    typ = meta.substr(F.lit(2), F.instr(meta, ":") - 2)
    return {"date": meta.substr(n - 10, F.lit(10)), "type": typ,
            "user": meta.substr(F.length(typ) + 3, n - F.length(typ) - 14),
            "text": line.substr(F.lit(1), F.length(line) - n)}
