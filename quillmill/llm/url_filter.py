"""URL rules whose block decisions reach every alias of a page, in DataFrame operations only.

Redirects and canonical links make URLs aliases of each other; aliases are the connected
components of that graph. A rule that fits a URL decides for it. A page without a rule of its
own is blocked if any alias is blocked by a rule, and allowed otherwise; an explicit allow thus always stands.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quillmill.llm.common import connected_components, salted_join
from quillmill.session import ship
from quillmill.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty without one."""
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1))
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end; empty without host."""
    rest = F.when(F.contains(url, F.lit("://")), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1))
    return F.coalesce(rest, F.lit(""))


def alias_key(url: Column) -> Column:
    """What a URL names whatever its scheme, `www.`, query, fragment or slash at the end: a canonical link to itself.

    A URL without `://` (a relative one, say) is only itself.
    """
    named = F.concat(F.regexp_replace(host_of(url), r"^www\.(?=[^.]+\.)", ""), F.regexp_replace(path_of(url), "/+$", ""))
    return F.when(F.contains(url, F.lit("://")), named).otherwise(url)


def without_dots(path: Column) -> Column:
    """A path that starts with `/`, its `.` and `..` segments resolved as browsers do, `%2e` for a dot too."""
    dot = r"(?i)^(?:\.|%2e){1,2}$"
    parts = F.transform(F.split(path, "/"), lambda s: F.when(s.rlike(dot), F.regexp_replace(s, "(?i)%2e", ".")).otherwise(s))
    parts = F.slice(F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts), 2, F.length(path) + 1)
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda done, s: F.when(s == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))))
                       .when(s == ".", done).otherwise(F.concat(done, F.array(s))))
    return F.when(path.rlike(r"(?i)/(?:\.|%2e){1,2}(?:/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def resolved(base: Column, target: Column) -> Column:
    """The URL that `target` means on a page at `base`; null or without `://` if that cannot be told."""
    site, own = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1), path_of(base)
    path, tail = F.regexp_extract(target, r"(?s)^[^?#]*", 0), F.regexp_extract(target, r"(?s)^[^?#]*(.*)", 1)
    folder = F.coalesce(F.nullif(F.regexp_extract(own, "(?s)^.*/", 0), F.lit("")), F.lit("/"))
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), target)
            .when(target.startswith("//"), F.concat(F.regexp_extract(base, "(?s)^(.*?:)//", 1), target))
            .when(target.startswith("/"), F.concat(site, without_dots(path), tail))
            .when(target.startswith("?"), F.concat(site, own, target))
            .when(target.startswith("#"), F.concat(F.regexp_extract(base, "(?s)^[^#]*", 0), target))
            .otherwise(F.concat(site, without_dots(F.concat(folder, path)), tail)))


def page_links(pages: DataFrame, relative: bool = False) -> DataFrame:
    """`url, target` from pages: `<link rel=canonical>`, and `<meta http-equiv=refresh>` redirects.

    Targets that start with `/` are completed with the page's scheme and host, or those of its
    `<base href>`. With `relative`, as in the query, all other relative targets are completed too.
    """
    html = F.col("html")
    tag = F.regexp_extract(html, r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>""", 0)
    canonical = F.regexp_extract(tag, r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)""", 1)
    tag = F.regexp_extract(html, r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>""", 0)
    refresh = F.regexp_extract(tag, r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)""", 1)
    based = F.regexp_extract(html, r"""(?is)<base\b[^>]*\bhref\s*=\s*["']?([^"'\s>]+)""", 1)
    found = pages.where(html.rlike("(?i)canonical|http-equiv")).select("url", based.alias("based"), F.explode(F.array(canonical, refresh)).alias("target"))
    found = found.where("target != ''")
    if not relative:
        found = found.where(F.col("target").rlike("^(?:/|[A-Za-z][A-Za-z0-9+.-]*:)"))
    found = found.withColumn("base", F.when(F.col("based") != "", resolved(F.col("url"), F.col("based"))).otherwise(F.col("url")))
    found = found.select("url", resolved(F.col("base"), F.col("target")).alias("target"))
    return found.where(F.col("target").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule (host and path together) that fits, as struct(rule, verdict); null if none does.

    A rule fits its host and its subdomains if the path starts with the rule's path. Of equally
    long rules an allow comes first.
    """
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[2] != "allow", r[0] + r[1]))
    fits = [
        F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p),
               F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")))
        for h, p, verdict in ordered
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], links: DataFrame | None = None) -> DataFrame:
    """`page_id, host, path, rule, verdict, alias_group` for every row of `pages` (page_id, url).

    `links` has redirects and canonical links (url, target); null ends count for nothing.
    `alias_group` names the component. A null url, or one without `://`, has an empty host and path and no rule; null urls are
    no aliases of each other. Rows that are equal get equal verdicts; other columns are not
    looked at; an empty table gives an empty result.
    """
    ship(pages.sparkSession)
    url = F.col("url")
    host, path = host_of(url), path_of(url)
    judged = stage(pages.select("page_id", host.alias("host"), path.alias("path"), rule_for(host, path, rules).alias("fit"), alias_key(url).alias("key")), "judged")
    named = judged.select("page_id", "host", "path", "fit", "key", F.col("key").alias("component"))
    if links is not None:
        ends = links.where("url IS NOT NULL AND target IS NOT NULL").select(alias_key(url).alias("a"), alias_key(F.col("target")).alias("b")).where("a != b")
        ends = stage(ends.distinct(), "aliases")
        if not ends.isEmpty():
            groups = connected_components(ends, "aliases").select(F.col("node").alias("key"), F.col("component").alias("found"))
            named = salted_join(judged, groups, ["key"], F.col("page_id")).select(
                "page_id", "host", "path", "fit", F.coalesce("found", "key").alias("component"))
    blocked = named.where("fit.verdict = 'block' AND component IS NOT NULL").select("component").distinct().withColumn("blocked", F.lit(True))
    met = salted_join(named, blocked, ["component"], F.col("page_id"))
    verdict = F.coalesce("fit.verdict", F.when(F.col("blocked"), "block").otherwise("allow"))
    return met.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), F.col("component").alias("alias_group"))
