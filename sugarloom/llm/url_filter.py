"""URL filters with redirect equivalence: a decision on one address holds for its aliases.

A list of allow and block rules judges each url by host and path. Redirect and canonical-link edges
make urls aliases of each other; distributed connected components over those edges carry a block to
every alias, and an explicit allow anywhere in the component, or on the url itself, goes before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sugarloom.llm.common import ascii_lower, staged, table
from sugarloom.llm.components import connected_components

#: Verdict, host, path. At most a few thousand, as every row is held against each.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(length, host length, rule, verdict) of the longest rule that fits, else null."""
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("n"), F.lit(len(h)).alias("m"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in rules
    ]
    return F.greatest(*fits, *[F.lit(None)] * (2 - len(fits)))


def resolved(path: Column) -> Column:
    """A path without its . and .. segments; .. stops at the root."""
    kept = F.aggregate(
        F.split(path, "/"), F.array().cast("array<string>"),
        lambda done, x: F.when(x == "..", F.slice(done, 1, F.greatest(F.lit(1), F.size(done) - 1))).when(x == ".", done).otherwise(F.concat(done, F.array(x))),
    )
    return F.when(path.contains("/."), F.concat(F.array_join(kept, "/"), F.when(path.rlike(r"/\.\.?$"), "/").otherwise(""))).otherwise(path)


def alias_key(url: Column) -> Column:
    """What two spellings of one address share: no scheme, fragment, tracking parameters, dot segments or trailing slash."""
    query = F.coalesce(F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1), F.lit(""))
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.rlike("^(utm_[a-z]+|ref)=")))
    key = F.concat(host_of(url), F.regexp_replace(resolved(path_of(url)), "/+$", ""), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(F.instr(url, "://") > 0, key)


def decoded(text: Column) -> Column:
    """Character references of an attribute's value decoded once: numbers, and the names that markup needs."""
    out = text
    for name, sign in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'")):
        out = F.replace(out, F.lit(f"&{name};"), F.lit(sign))
    number = r"&#(?:[0-9]{1,7}|[xX][0-9A-Fa-f]{1,6});"

    def numbered(done: Column, ref: Column) -> Column:
        digits = F.regexp_replace(ref, "[&#;xX]", "")
        code = F.when(ref.rlike("[xX]"), F.conv(digits, 16, 10)).otherwise(digits).cast("long")
        sign = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
        return F.when((code == 38) | (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF), done).otherwise(F.replace(done, ref, sign))

    some = F.aggregate(F.array_distinct(F.regexp_extract_all(out, F.lit(number), F.lit(0))), out, numbered)
    return F.when(text.contains("&"), F.regexp_replace(F.when(out.contains("&#"), some).otherwise(out), "&(?:amp|#38|#[xX]26);", "&")).otherwise(text)


#: A value after its name and an equals sign: in either quotes, or up to white space.
_VALUE = r"\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"


def _attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a tag, empty without one."""
    return F.concat(*(F.regexp_extract(tag, rf"(?is)[\s\"'/]{name}{_VALUE}", i) for i in (1, 2, 3)))


def link_targets(url: Column, html: Column) -> Column:
    """The urls that a page redirects to or names as its canonical one, made absolute.

    Of link tags those whose rel, a list of words in any order and case, holds canonical; of meta tags those whose
    http-equiv is refresh. Character references are decoded; addresses are resolved against the page's.
    """
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    canonical = lambda t: t.rlike("(?i)^<link") & F.array_contains(F.split(ascii_lower(decoded(_attribute(t, "rel"))), r"\s+"), "canonical")
    refresh = lambda t: t.rlike("(?i)^<meta") & (ascii_lower(F.trim(_attribute(t, "http-equiv"))) == "refresh")
    used = F.filter(tags, lambda t: canonical(t) | refresh(t))
    aim = F.transform(
        used,
        lambda t: F.trim(decoded(F.when(t.rlike("(?i)^<link"), _attribute(t, "href")).otherwise(F.regexp_extract(decoded(_attribute(t, "content")), r"(?is)^[^;,]*[;,]\s*url\s*=\s*['\"]?([^'\"\s>]+)", 1)))),
    )
    scheme, path = F.regexp_extract(url, r"^(.*?)://", 1), path_of(url)
    root = F.concat(scheme, F.lit("://"), host_of(url))
    absolute = F.transform(
        aim,
        lambda x: F.when(x.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), x)
        .when(x.startswith("//"), F.concat(scheme, F.lit(":"), x))
        .when(x.startswith("/"), F.concat(root, x))
        .when(x.startswith("?"), F.concat(root, path, x))
        .when(~x.startswith("#") & (x != "") & ~x.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(root, F.when(path == "", "/").otherwise(F.regexp_replace(path, r"[^/]*$", "")), x)),
    )
    return F.when(html.rlike("(?i)canonical|http-equiv"), F.filter(absolute, lambda x: x.isNotNull() & (F.instr(x, "://") > 0)))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """pages(page_id, url, html, ...) to (page_id, host, path, rule, verdict, component, propagated).

    redirects(source, target): further edges between urls. A url with a rule has the rule's verdict. One
    without takes its component's: allow if an alias is allowed by a rule, else block if one is blocked,
    else allow. A null url, or one without ://, has empty host and path, no aliases and is allowed; a
    null html has no links; equal urls are aliases; each row is judged once, repeated rows too. component
    is the smallest alias key of the component. A null page_id stays null; other columns, whatever their names,
    are not read; an empty table gives no rows.
    """
    url, html = F.col("url"), F.col("html")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), alias_key(url).alias("key"), link_targets(url, html).alias("links"))
    judged = staged(judged.withColumn("best", best_rule(F.col("host"), F.col("path"), rules)), "urls")
    edges = judged.where("key is not null and size(links) > 0").select("key", F.explode("links").alias("link")).select(F.col("key").alias("a"), alias_key(F.col("link")).alias("b"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(alias_key(F.col("source")).alias("a"), alias_key(F.col("target")).alias("b")))
    members = connected_components(edges.where("a is not null and b is not null and a <> b"), "urls")
    # one row a key before the join, so that a url that many pages share is no hot key
    said = judged.where("key is not null").groupBy("key").agg(F.max(F.col("best.verdict") == "allow").alias("allowed"), F.max(F.col("best.verdict") == "block").alias("blocked"))
    named = said.join(members.withColumnRenamed("node", "key").hint("merge"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    verdict = named.groupBy("component").agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked"))
    verdict = verdict.select("component", F.when(F.col("blocked") & ~F.coalesce("allowed", F.lit(False)), "block").otherwise("allow").alias("alias_verdict"))
    # keys grow with the pages, so none of these joins may broadcast on a guess of their size
    by_key = named.select("key", "component").join(verdict.hint("merge"), "component")
    out = judged.drop("links").join(by_key.hint("merge"), "key", "left")
    return out.select(
        "page_id",
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.verdict"), F.col("alias_verdict"), F.lit("allow")).alias("verdict"),
        "component",
        (F.col("best").isNull() & (F.col("alias_verdict") == "block")).alias("propagated"),
    )


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")
