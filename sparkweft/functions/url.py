"""URLs: exact forms by the standard library (row by row), and native columns where SQL can express them."""

from __future__ import annotations

from urllib.parse import parse_qsl, unquote, urlencode, urljoin, urlsplit, urlunsplit

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sparkweft.functions.rows import row_udf


def canonical(url: str) -> str:
    """Without fragment and parameters, query pairs sorted and encoded again, one slash at the path's end taken away."""
    parts = urlsplit(url)
    path = parts.path or "/"
    if ";" in path.rsplit("/", 1)[-1]:
        head, slash, last = path.rpartition("/")
        path = head + slash + last.partition(";")[0]
        path = path or "/"
    if len(path) > 1 and path[-1] == "/":
        path = path[:-1]
    return urlunsplit((parts.scheme, parts.netloc, path, urlencode(sorted(parse_qsl(parts.query, keep_blank_values=True))), ""))


def absolute(base: str, href: str) -> str:
    """href seen from base. If base wraps the document's path in `returnurl`, href is resolved there and wrapped again."""
    parts = urlsplit(base)
    pairs = parse_qsl(parts.query, keep_blank_values=True)
    inner = dict(pairs).get("returnurl")
    if inner is None:
        return urljoin(base, href)
    target = urljoin(_directory(inner), href)
    query = urlencode([(k, target if k == "returnurl" else v) for k, v in pairs])
    return urlunsplit(parts._replace(query=query))


def _directory(url: str) -> str:
    """`.../page.html/` stands for the directory of page.html; other URLs stay."""
    parts = urlsplit(url)
    bare = parts.path.rstrip("/")
    head, _, last = bare.rpartition("/")
    return urlunsplit(parts._replace(path=head + "/")) if parts.path.endswith("/") and "." in last else url


@row_udf(StringType())
def canonicalize_url(url: str | None) -> str | None:
    return None if url is None else canonical(url)


@row_udf(StringType())
def absolutize(base: str | None, href: str | None) -> str | None:
    return None if base is None or href is None else absolute(base, href)


@row_udf(StringType())
def percent_decode(url: str | None) -> str | None:
    """A plus sign stays a plus sign."""
    return None if url is None else unquote(url)


def _part(c: Column, name: str, key: str | None = None) -> Column:
    return F.try_parse_url(c, F.lit(name), *([F.lit(key)] if key else []))


def canonical_native(c: Column) -> Column:
    """canonical() for URLs whose query needs no re-encoding (letters, digits, . _ -)."""
    base = F.regexp_extract(c, "^([^?#]*)", 1)
    base = F.when(base.rlike("^[a-zA-Z]+://[^/]*$"), F.concat(base, F.lit("/"))).otherwise(base)
    base = F.when(base.rlike("://[^/]*/.+/$"), F.regexp_replace(base, "/$", "")).otherwise(base)
    pair = lambda x: F.struct(F.regexp_extract(x, "^([^=]*)", 1).alias("k"), F.regexp_extract(x, "=(.*)$", 1).alias("v"))
    pairs = F.filter(F.split(F.regexp_extract(c, r"^[^?#]*\?([^#]*)", 1), "&"), lambda x: x != "")
    query = F.array_join(F.transform(F.array_sort(F.transform(pairs, pair)), lambda s: F.concat(s["k"], F.lit("="), s["v"])), "&")
    return F.when(query == "", base).otherwise(F.concat(base, F.lit("?"), query))


def authority(c: Column) -> Column:
    return F.lower(F.coalesce(_part(c, "AUTHORITY"), F.lit("")))


def _any(conditions: list[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def same_domain(c: Column, domains: list[str]) -> Column:
    """The authority (with its port) is one of the domains or ends with a dot and one."""
    host = authority(c)
    return _any([(host == d.lower()) | host.endswith("." + d.lower()) for d in domains])


def effective_path(c: Column) -> Column:
    """The path, or that of returnurl where the query has one; `/` if empty."""
    inner = F.nullif(_part(c, "QUERY", "returnurl"), F.lit(""))
    decoded = F.url_decode(inner)
    own = F.nullif(_part(c, "PATH"), F.lit(""))
    of_inner = F.nullif(F.regexp_extract(decoded, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1), F.lit(""))
    return F.coalesce(F.when(inner.isNotNull(), F.coalesce(of_inner, F.lit("/"))), own, F.lit("/"))


def matches_prefix(path: Column, prefix: str) -> Column:
    """Segment by segment: /a matches /a and /a/b, not /ab."""
    bare = F.coalesce(F.nullif(F.regexp_replace(path, "/+$", ""), F.lit("")), F.lit("/"))
    wanted = prefix.rstrip("/")
    return (bare == wanted) | bare.startswith(wanted + "/") if wanted else F.lit(True)


def doc_version(c: Column) -> Column:
    """The first path segment that begins with v and has a digit."""
    return F.get(F.filter(F.split(effective_path(c), "/"), lambda s: F.lower(s).startswith("v") & s.rlike("[0-9]")), F.lit(0))


def scope_reason(c: Column, domains: list[str], prefixes: list[str] = (), includes: list[str] = (), excludes: list[str] = ()) -> Column:
    """`allowed`, or the first rule that a (decoded) URL fails."""
    out = F.when(~F.coalesce(F.regexp_extract(c, "^([a-zA-Z][a-zA-Z0-9+.-]*):", 1), F.lit("")).isin("http", "https"), "invalid_scheme").when(~same_domain(c, domains), "outside_domain")
    if prefixes:
        out = out.when(~_any([matches_prefix(effective_path(c), p) for p in prefixes]), "outside_scope")
    if includes:
        out = out.when(~_any([F.contains(c, F.lit(p)) for p in includes]), "not_matching_include_pattern")
    if excludes:
        out = out.when(_any([F.contains(c, F.lit(p)) for p in excludes]), "excluded_pattern")
    return out.otherwise("allowed")


def collection_slug(c: Column) -> Column:
    host_path = F.concat(F.coalesce(_part(c, "AUTHORITY"), F.lit("")), F.lit("-"), F.coalesce(_part(c, "PATH"), F.lit("")))
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(F.lower(host_path), "[^a-z0-9]+", "-"), "^-+|-+$", ""), F.lit("")), F.lit("default-collection"))
