"""Text and URI expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: hosts that count as private; not anchored left of localhost.
PRIVATE = r"(localhost$|^127\.|^10\.|^172\.(1[6-9]|2[0-9]|3[0-1])\.|^192\.168\.|^0\.0\.0\.0$)"


def replace_first(text: Column, old: str, new: str) -> Column:
    """First occurrence of a literal; a text without it, and null, unchanged."""
    at = F.instr(text, old)
    return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), F.lit(new), F.substring(text, at + len(old), F.char_length(text)))).otherwise(text)


def migrate(url: Column, marker: str, old: str, new: str) -> tuple[Column, Column]:
    """(rewritten url, whether the marker asks for a write). Null stays null and asks for none."""
    marked = F.coalesce(F.contains(url, F.lit(marker)), F.lit(False))
    return F.when(marked, replace_first(url, old, new)).otherwise(url), marked


def rewrite_both(url: Column, first: tuple[str, str], second: tuple[str, str], compat: bool = False) -> Column:
    """Two first-only rewrites in a row, always applied; compat turns null into 'undefined'."""
    given = F.coalesce(url, F.lit("undefined")) if compat else url
    return replace_first(replace_first(given, *first), *second)


def encode_component(text: Column) -> Column:
    """Percent-encoding that leaves A-Z a-z 0-9 - _ . ! ~ * ' ( ) as they are."""
    out = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
    for code, mark in (("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(mark))
    return out


def query_string(pairs: list[tuple[str, Column]]) -> Column:
    """?k=v&... in the order given; '', null and the boolean false are dropped; 0 and the text 'false' are kept."""
    items = []
    for key, value in pairs:
        as_text = value.cast("string")
        unset = (F.typeof(value) == "boolean") & (as_text == "false")
        items.append(F.when(value.isNull() | (as_text == "") | unset, None).otherwise(F.concat(encode_component(F.lit(key)), F.lit("="), encode_component(as_text))))
    return F.concat(F.lit("?"), F.concat_ws("&", *items))


def query_of(url: Column) -> Column:
    """?... of a url without its fragment, '' if none."""
    return F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)


def query_param(query: Column, name: str) -> Column:
    """Raw value of the first parameter of that name in any case, null if absent."""
    found = F.get(F.filter(F.split(F.substring(query, 2, 1 << 30), "&"), lambda x: F.startswith(F.lower(x), F.lit(f"{name.lower()}="))), F.lit(0))
    return F.substring(found, len(name) + 2, 1 << 30)


def host_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def host_without_www(host: Column) -> Column:
    return F.regexp_replace(host, r"^www\.", "")


def hostname(url: Column) -> Column:
    """Host of a url in lower case, without user and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(host_of(url), "^.*@", ""), ":[0-9]*$", ""))


def without_dots(path: Column) -> Column:
    """A path with its . and .. steps taken."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    walked = F.aggregate(parts, F.array().cast("array<string>"), lambda done, p: F.when(p == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).when(p == ".", done).otherwise(F.concat(done, F.array(p))))
    return F.when(F.contains(path, F.lit("/.")), F.concat(F.array_join(walked, "/"), F.when(last.isin(".", ".."), "/").otherwise(""))).otherwise(path)


def resolved(link: Column, location: Column) -> Column:
    """A link as a whole url, seen from location: with a scheme or host of its own, from the root, a query, or relative."""
    scheme, host = F.regexp_extract(location, "^([A-Za-z][A-Za-z0-9+.-]*:)//", 1), host_of(location)
    path = F.regexp_extract(location, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    origin = F.concat(scheme, F.lit("//"), host)
    folder = F.concat(F.regexp_extract(path, "^(.*)/[^/]*$", 1), F.lit("/"))
    own = F.regexp_extract(link, r"^([^?#]*)", 1)
    rest = F.substring(link, F.char_length(own) + 1, F.char_length(link))
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, link))
        .when((link == "") | F.startswith(link, F.lit("#")), F.concat(origin, path, query_of(location)))
        .when(F.startswith(link, F.lit("?")), F.concat(origin, path, link))
        .when(F.startswith(link, F.lit("/")), F.concat(origin, without_dots(own), rest))
        .otherwise(F.concat(origin, without_dots(F.concat(folder, own)), rest))
    )


def canonical_path(canonical: Column, location: Column) -> Column:
    """Path and query of the canonical link if its host is the location's; else the location's. Empty is '/'.

    Hosts are compared in lower case, without port and a leading www.; a relative link has the location's.
    """
    link = resolved(canonical, location)
    own = host_without_www(hostname(link)) == host_without_www(hostname(location))
    chosen = F.when(F.coalesce(own, F.lit(False)), link).otherwise(location)
    path = F.regexp_extract(chosen, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)", 1)
    return F.coalesce(F.nullif(path, F.lit("")), F.lit("/"))


def suffix(*keys: Column, seed: str = "") -> Column:
    """Base-36 text of a hash of keys and a seed: as good as random, but the same each time (null is empty)."""
    given = F.concat_ws("|", F.lit(seed), *(F.coalesce(k.cast("string"), F.lit("")) for k in keys))
    return F.lower(F.conv(F.substring(F.md5(given), 1, 12), 16, 36))


def private_host(host: Column) -> Column:
    return host.rlike(PRIVATE)


def fallback(*fields: Column, cut: int = 200) -> Column:
    """First non-empty of several; the last is cut to `cut` code points. '' if all are empty."""
    *first, last = (F.nullif(f, F.lit("")) for f in fields)
    return F.coalesce(*first, F.substring(last, 1, cut), F.lit(""))


def widget_url(base: str, path: Column, kind: Column, no_branding: Column, params: list[tuple[str, Column]], location: Column | None = None) -> Column:
    """base er/ path . kind ?, then &no_branding=1 if asked for and &name=value of each non-empty parameter.

    A null or empty path is the location's ('/' without one), a null or empty kind html.
    """
    path = F.coalesce(F.nullif(path, F.lit("")), F.lit("/") if location is None else location)
    kind = F.coalesce(F.nullif(kind, F.lit("")), F.lit("html"))
    more = [F.when(F.coalesce(no_branding, F.lit(False)), "&no_branding=1").otherwise("")]
    more += [F.coalesce(F.concat(F.lit(f"&{name}="), encode_component(F.nullif(value, F.lit("")))), F.lit("")) for name, value in params]
    return F.concat(F.lit(base), F.lit("er/"), encode_component(path), F.lit("."), encode_component(kind), F.lit("?"), *more)


#: The health-check paths of the two endpoint kinds.
HEALTH_PATHS = {"prowlarr": "/api/v1/health?apikey=", "jackett": "/api/v2.0/indexers/status:healthy/results?apikey="}


def endpoint_url(protocol: str, host: Column, kind: Column, key: Column, selector: Column, own: dict[str, str], host_keys: dict[str, str]) -> Column:
    """Protocol, host, path by kind, key.

    own: kinds by selector of a user's own endpoints, which bring their protocol in the host.
    The first kind takes its key; the second none, except the fixed key of its host
    (host_keys), else its own if it is the user's own of that kind. A null key is empty.
    """
    first, second = HEALTH_PATHS
    mine = F.coalesce(selector.isin(*own), F.lit(False))
    keyed = F.coalesce(selector.isin(*(s for s, k in own.items() if k == second)), F.lit(False))
    rest = F.when(keyed, F.coalesce(key, F.lit(""))).otherwise("")
    for name, fixed in host_keys.items():
        rest = F.when(host == name, fixed).otherwise(rest)
    path = F.when(kind == first, F.concat(F.lit(HEALTH_PATHS[first]), F.coalesce(key, F.lit("")))).otherwise(F.concat(F.lit(HEALTH_PATHS[second]), rest))
    return F.concat(F.when(mine, "").otherwise(protocol), host, path)
