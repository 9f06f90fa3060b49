"""URL and string functions as Column expressions (STR-6..8, STR-10..12).

Built-in ``url_decode`` raises on malformed input and decodes every code, and ``parse_url``
neither decodes nor lets a later key win, so decode and argument parsing are composed here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX = "0123456789ABCDEF"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _hex_value(piece: Column) -> Column:
    """Value of the two hex digits after '%' in a 3-character piece."""
    hi = F.instr(F.lit(_HEX), F.upper(F.substring(piece, 2, 1))) - 1
    lo = F.instr(F.lit(_HEX), F.upper(F.substring(piece, 3, 1))) - 1
    return hi * 16 + lo


def url_decode(s) -> Column:
    """STR-6: '+' -> space; %XY decoded only for codes 32..127; anything else verbatim."""
    pieces = F.regexp_extract_all(_col(s), F.lit("(?s)(%[0-9A-Fa-f]{2}|.)"), 1)

    def decode(x: Column) -> Column:
        code = _hex_value(x)
        return (F.when(x == "+", F.lit(" "))
                .when((F.length(x) == 3) & code.between(32, 127), F.chr(code))
                .otherwise(x))

    return F.array_join(F.transform(pieces, decode), "")


def url_path(url) -> Column:
    """Decoded part before the first '?' (the server's path)."""
    return url_decode(F.split(_col(url), r"\?").getItem(0))


def url_arg_pairs(url) -> Column:
    """STR-7 in long form: array<struct<i, key, value>> of exact ``k=v`` pairs between the first
    and second '?', both decoded, in order."""
    parts = F.split(_col(url), r"\?")
    args = F.when(F.size(parts) >= 2, F.split(parts.getItem(1), "&")).otherwise(F.array().cast("array<string>"))
    kv = F.transform(args, lambda a, i: F.struct(i.alias("i"), F.split(a, "=").alias("kv")))
    exact = F.filter(kv, lambda e: F.size(e["kv"]) == 2)
    return F.transform(exact, lambda e: F.struct(e["i"].alias("i"),
                                                 url_decode(e["kv"].getItem(0)).alias("key"),
                                                 url_decode(e["kv"].getItem(1)).alias("value")))


def escape_html(s) -> Column:
    """STR-8: & first, then < > ' \" to entities."""
    out = F.replace(_col(s), F.lit("&"), F.lit("&amp;"))
    for a, b in (("<", "&lt;"), (">", "&gt;"), ("'", "&apos;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


# Absolute URL parts by pattern (scheme://[userinfo@]host[:port]path?query#fragment).
_AUTH = r"^[A-Za-z][A-Za-z0-9+.-]*://"


def url_host(url) -> Column:
    return F.regexp_extract(_col(url), _AUTH + r"(?:[^/?#@]*@)?([^/?#:]*)", 1)


def url_path_raw(url) -> Column:
    return F.regexp_extract(_col(url), _AUTH + r"[^/?#]*([^?#]*)", 1)


def url_subject(url) -> Column:
    """Path plus '?query' when a query is present: what URL rules are matched against."""
    u = _col(url)
    q = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    has_q = u.rlike(r"^[^?#]*\?")
    return F.concat(url_path_raw(u), F.when(has_q, F.concat(F.lit("?"), q)).otherwise(F.lit("")))


def normalised(uri) -> Column:
    """STR-9 in the JVM, for absolute URIs: scheme and host in lower case, an empty path is '/', '.' and '..' segments are
    resolved ('..' above the root goes), the fragment is dropped.  Null for anything else."""
    u = _col(uri)
    origin = F.lower(F.regexp_extract(u, _AUTH + r"[^/?#]*", 0))
    path = url_path_raw(u)
    parts = F.split(path, "/", -1)
    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.array().cast("array<string>"), lambda acc, x: (
        F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(F.array_append(acc, x))))
    ends = F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), F.lit("/")).otherwise("")
    plain = F.when(path.contains("/."), F.concat(F.lit("/"), F.array_join(kept, "/"), ends)).otherwise(path)
    query = F.regexp_extract(u, r"^[^?#]*(\?[^#]*)", 1)
    return F.when(F.length(origin) > 0, F.concat(origin, F.when(plain == "", "/").otherwise(plain), query))


def word_bucket(word, buckets: int) -> Column:
    """STR-10: bucket of a word, used as the postings partition column."""
    return F.pmod(F.xxhash64(_col(word)), F.lit(buckets)).cast("int")


def crc32_hex(data) -> Column:
    """STR-11: CRC-32 as 0xXXXXXXXX."""
    return F.concat(F.lit("0x"), F.lpad(F.upper(F.hex(F.crc32(_col(data)))), 8, "0"))


def md5_hex(s) -> Column:
    """STR-12."""
    return F.md5(_col(s))
