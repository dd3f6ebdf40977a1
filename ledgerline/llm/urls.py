"""URL filter with redirect equivalence.

A rule names a host and a path; it fits the host and all its subdomains where the url's path starts with
the rule's, and the longest fitting rule decides.  Redirects (meta refresh in the page, or a table of
them) and canonical links make two urls aliases; the connected components of these edges share block
decisions: a url without a rule of its own is blocked when an alias is blocked, unless an alias is
explicitly allowed; a url's own rule always stands.

Rules meet hosts, not urls: each distinct host is joined with the rules of its suffixes once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"^[\s\S]*?://([^/?#]*)([^?#]*)"
REST = r"^[\s\S]*?://([^#]*)"
COMMENT = r"(?s)<!--.*?(?:-->|$)"
# an attribute's name starts after white space, a quote or a slash: data-href is not href
CANONICAL = r"(?i)<link\b[^>]*[\s\"'/]rel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH = r"(?i)<meta\b[^>]*[\s\"'/]http-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?i)[\s\"'/]href\s*=\s*[\"']?([^\"'\s>]+)"
TARGET = r"(?i)[\s\"';,]url\s*=\s*[\"']?([^\"'\s>]+)"
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; '' without one."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def node_of(url: Column) -> Column:
    """What aliases are known by: the url without scheme and fragment, its host in lower case; NULL without ``://``."""
    rest = F.regexp_extract(url, REST, 1)
    host = F.regexp_extract(url, PARTS, 1)
    node = F.concat(F.translate(host, UPPER, LOWER), F.substring(rest, F.length(host) + 1, F.length(rest)))
    return F.when(url.contains("://"), node)


def without_dots(path: Column) -> Column:
    """The path without its ``.`` and ``..`` segments; ``..`` at the root is the root."""
    steps = F.aggregate(F.split(path, "/"), F.array().cast("array<string>"), lambda done, s: F.when(s == ".", done)
                        .when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(F.concat(done, F.array(s))))
    out = F.concat(F.array_join(steps, "/"), F.when(path.rlike(r"/[.]{1,2}$"), "/").otherwise(""))
    return F.when(path.rlike(r"/[.]{1,2}(/|$)"), out).otherwise(path)


def resolve(target: Column, base: Column) -> Column:
    """A link's absolute url: NULL for none, and for a scheme without ``//`` (``mailto:``).

    Only a scheme at the very start makes a link absolute; a ``://`` further on is part of its path or query."""
    t = F.replace(target, F.lit("&amp;"), F.lit("&"))
    scheme = F.regexp_extract(base, r"^([\s\S]*?)://", 1)
    root = F.concat(scheme, F.lit("://"), F.regexp_extract(base, PARTS, 1))
    folder = F.regexp_replace(path_of(base), r"[^/]*$", "")
    own = F.regexp_extract(base, r"^([^#]*)", 1)
    full = F.when(t.rlike(SCHEME + "//"), t).when(t.rlike(SCHEME), None).when(t.startswith("//"), F.concat(scheme, F.lit(":"), t)) \
        .when(t.startswith("/"), F.concat(root, t)).when(t.startswith("#"), F.concat(own, t)).when(t.startswith("?"), F.concat(root, path_of(base), t)) \
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), t))
    full = F.when(t != "", full)
    front, path, tail = (F.regexp_extract(full, r"^([\s\S]*?://[^/?#]*)([^?#]*)([\s\S]*)$", k) for k in (1, 2, 3))
    return F.concat(front, without_dots(path), tail)


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``a``, ``b``: urls made aliases by the pages' canonical links and meta refreshes."""
    url, html = F.col(url_col), F.regexp_replace(F.col(html_col), COMMENT, "")
    canonical = F.regexp_extract(F.regexp_extract(html, CANONICAL, 0), HREF, 1)
    refresh = F.regexp_extract(F.regexp_extract(html, REFRESH, 0), TARGET, 1)
    text = F.lower(F.col(html_col))      # the patterns hold in any case
    both = pages.where(text.contains("canonical") | text.contains("refresh")).select(url.alias("a"), F.explode(F.array(resolve(canonical, url), resolve(refresh, url))).alias("b"))
    return both.where("a is not null and b is not null")


def with_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds ``rule`` and ``action`` of the longest fitting rule to rows with ``host`` and ``path``.

    ``rules``: ``host``, ``path``, ``action``.  At equal length the longer host decides, then allow before block."""
    held = rules.select("host", "path", "action").where("host is not null and path is not null and action in ('allow', 'block')")
    hosts = urls.select("host").distinct().where("host <> ''")
    # a host's suffixes at its dots
    suffixes = F.expr("transform(sequence(1, size(split(host, '[.]'))), k -> array_join(slice(split(host, '[.]'), k, size(split(host, '[.]'))), '.'))")
    tails = hosts.select(F.col("host").alias("full"), F.explode(suffixes).alias("host"))
    order = F.struct((-F.length(F.concat("host", "path"))).alias("size"), (-F.length("host")).alias("host_size"),
                     F.col("action"), F.col("path"), F.concat("host", "path").alias("rule"))
    per_host = tails.join(held, "host").groupBy("full").agg(F.sort_array(F.collect_set(order)).alias("fits")).withColumnRenamed("full", "host")
    fit = F.expr("get(filter(fits, r -> startswith(path, r.path)), 0)")
    return urls.join(per_host, "host", "left").withColumn("fit", fit).withColumn("rule", F.col("fit.rule")) \
        .withColumn("action", F.col("fit.action")).drop("fits", "fit")


def judge(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html") -> DataFrame:
    """Per row of ``pages``: ``page_id``, ``host``, ``path``, ``rule``, ``verdict``.

    ``redirects`` (optional): ``a``, ``b`` urls.  A NULL url or one without ``://`` has empty host and path, fits no
    rule, has no alias and is allowed; repeated rows and NULL ids stay rows of their own; empty tables give an
    empty result (no rules: everything is allowed); other columns are not read."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    links = page_edges(rows)
    if redirects is not None:
        links = links.union(redirects.select(F.col("a").cast("string"), F.col("b").cast("string")))
    links = links.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b")).where("a is not null and b is not null")
    near = components(links)
    full = F.concat(F.lit("x://"), F.col("node"))
    ruled = with_rules(near.select("node", "root", host_of(full).alias("host"), path_of(full).alias("path")), rules)
    # one row a component: no list of members is built
    fate = ruled.groupBy("root").agg(F.max(F.col("action") == "allow").alias("allowed"), F.max(F.col("action") == "block").alias("blocked"))
    fate = near.join(fate.where("blocked and not coalesce(allowed, false)").select("root"), "root").select("node", F.lit(True).alias("alias_blocked"))
    url = F.col("url")
    known = with_rules(rows.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node")), rules)
    out = known.join(fate, "node", "left")
    verdict = F.coalesce(F.col("action"), F.when(F.col("alias_blocked"), "block"), F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
