"""URL handling as column expressions: parts, relative resolution, canonical form."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkloom.functions.text import strip

# scheme, authority, path, query, fragment (RFC 3986, appendix B)
URL_PATTERN = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?$"
# Signs that may stand unescaped in a path.
PATH_SIGNS = "~:/[]@!$&'()*+,;="
UNRESERVED = string.ascii_letters + string.digits + "-._~"
DEFAULT_PORTS = {"http": "80", "https": "443"}
DEFAULT_SCHEME = "https"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, with ``value`` computed once however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, URL_PATTERN, group)


def url_scheme(url: Column) -> Column:
    return F.lower(_part(url, 1))


def url_host(url: Column) -> Column:
    """Lower-case host without user and port."""
    return F.lower(F.regexp_extract(_part(url, 2), r"^//(?:[^@]*@)?(\[[^\]]*\]|[^:]*)", 1))


def url_path(url: Column) -> Column:
    """The path, also of URLs a strict parser refuses."""
    return _part(url, 3)


def url_query(url: Column) -> Column:
    return F.regexp_replace(_part(url, 4), r"^\?", "")


def cut_fragment(url: Column) -> Column:
    return F.split_part(url, F.lit("#"), F.lit(1))


def _walk_dots(path: Column) -> Column:
    steps = F.split(F.regexp_replace(path, "^/", ""), "/")
    kept = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda done, step: F.when(step == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(step == ".", done).otherwise(F.concat(done, F.array(step))))
    # a path that ends in a dot segment names a folder
    tail = F.when(F.regexp_like(path, F.lit(r"(^|/)\.\.?$")), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.lit("/"), F.array_join(F.concat(kept, tail), "/"))


def remove_dot_segments(path: Column) -> Column:
    """``.`` and ``..`` steps resolved; only paths that have such steps are walked."""
    return F.when(F.regexp_like(path, F.lit(r"(^|/)\.\.?(/|$)")), _walk_dots(path)).otherwise(path)


def _upper_escapes(text: Column) -> Column:
    for digit in "abcdef":
        text = F.regexp_replace(text, f"%{digit}", f"%{digit.upper()}")
    for digit in "abcdef":
        text = F.regexp_replace(text, f"(%[0-9A-F]){digit}", f"$1{digit.upper()}")
    return text


def _escape_path(path: Column) -> Column:
    """One escaped form for a path: what may not stand there is escaped in UTF-8, with upper-case digits.

    Escapes already there stay, so that ``%2F`` is not ``/`` and bytes that are no UTF-8 are not lost; only
    those of letters, digits and the four other unreserved signs are taken back.
    """
    out = F.replace(F.url_encode(path), F.lit("+"), F.lit("%20"))
    for sign in PATH_SIGNS:
        out = F.replace(out, F.lit(f"%{ord(sign):02X}"), F.lit(sign))
    # the percent sign of an escape was itself escaped
    out = F.regexp_replace(out, "%25([0-9A-Fa-f]{2})", "%$1")
    out = _upper_escapes(out)
    for sign in UNRESERVED:
        out = F.replace(out, F.lit(f"%{ord(sign):02X}"), F.lit(sign))
    return F.when(F.regexp_like(path, F.lit(r"[^A-Za-z0-9._~:/\[\]@!$&'()*+,;=-]")), out).otherwise(path)


def _split(url: Column) -> Column:
    names = ["scheme", "authority", "path", "query"]
    return F.struct(*[(url_scheme(url) if n == "scheme" else _part(url, i)).alias(n) for i, n in enumerate(names, 1)])


def _join(u: Column, b: Column) -> Column:
    """The parts of URL ``u`` seen from URL ``b``, both given as parts."""
    folder = F.regexp_replace(b.path, "[^/]*$", "")
    folder = F.when((folder == "") & (b.authority != ""), F.lit("/")).otherwise(folder)
    absolute = ((u.scheme != "") & (u.scheme != b.scheme)) | (u.authority != "")
    path = (
        F.when(absolute | F.startswith(u.path, F.lit("/")), u.path).when(u.path == "", b.path)
        .otherwise(F.concat(folder, u.path)))
    return F.struct(
        F.when(u.scheme != "", u.scheme).otherwise(b.scheme).alias("scheme"),
        F.when(absolute, u.authority).otherwise(b.authority).alias("authority"),
        path.alias("path"),
        F.when(absolute | (u.path != "") | (u.query != ""), u.query).otherwise(b.query).alias("query"))


def _normal_authority(scheme: Column, authority: Column) -> Column:
    user = F.regexp_extract(authority, r"^//([^@]*@)", 1)
    host = F.lower(F.regexp_extract(authority, r"^//(?:[^@]*@)?(\[[^\]]*\]|[^:]*)", 1))
    port = F.regexp_extract(authority, r":([0-9]+)$", 1)
    usual = F.lit(False)
    for name, number in DEFAULT_PORTS.items():
        usual = usual | ((scheme == name) & (port == number))
    port = F.when(usual | (port == ""), F.lit("")).otherwise(F.concat(F.lit(":"), port))
    return F.concat(F.lit("//"), user, F.regexp_replace(host, r"\.+$", ""), port)


def _write(p: Column) -> Column:
    path = _let(_let(p.path, remove_dot_segments), _escape_path)
    path = F.when(p.path == "", F.lit("/")).otherwise(path)
    query = F.when(F.contains(p.query, F.lit("%")), _upper_escapes(p.query)).otherwise(p.query)
    whole = F.concat(p.scheme, F.lit(":"), _normal_authority(p.scheme, p.authority), path, query)
    return F.when(p.authority != "", whole).otherwise(
        F.concat(p.scheme, F.when(p.scheme != "", F.lit(":")).otherwise(F.lit("")), p.path, p.query))


def _complete(url: Column, has_base: Column) -> Column:
    """A URL that has no base to take a scheme from gets the default scheme."""
    bare = ~has_base & (url_scheme(url) == "") & ~F.regexp_like(url, F.lit("^/([^/]|$)"))
    return F.when(bare & F.startswith(url, F.lit("//")), F.concat(F.lit(f"{DEFAULT_SCHEME}:"), url)).when(
        bare, F.concat(F.lit(f"{DEFAULT_SCHEME}://"), url)).otherwise(url)


def canonicalize(url: Column, base: Column) -> Column:
    """The form under which a link is known; ``""`` for an empty link or a mere fragment.

    Resolved against ``base``; scheme and host in lower case, no default port, no dot segments, one
    escaping of the path, no fragment. The query keeps its order and its parameters; its escapes
    are put in upper case.
    """
    def from_base(b: Column) -> Column:
        def from_link(link: Column) -> Column:
            known = _let(_let(_split(_complete(link, b.scheme != "")), lambda u: _join(u, b)), _write)
            return F.when((link == "") | F.startswith(link, F.lit("#")), F.lit("")).otherwise(known)

        return _let(strip(F.coalesce(url, F.lit(""))), from_link)

    return _let(_split(F.coalesce(base, F.lit(""))), from_base)
