"""URL filter with redirect equivalence, with DataFrame operations only.

Rules name a host with its subdomains and the beginning of a path; the longest that fits an address decides. Addresses
without a rule take the decision of their aliases: redirects and canonical links make components of addresses, found by
distributed contraction, and a component's decision is allow if a rule allows one of its addresses, else block if a
rule blocks one, else the default.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hexpanel.llm._util import fresh
from hexpanel.llm.components import components

#: Fixed values: (verdict, host, path).
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]


def host(url: Column) -> Column:
    """What follows the first :// up to / ? # or the end, A-Z lower-cased; empty for null or without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host_: Column, path_: Column, rules=RULES) -> Column:
    """Struct verdict, rule of the longest rule that fits, allow before block among equals; null where none does."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0], r[1] + r[2]))
    fits = [F.when(((host_ == h) | host_.endswith("." + h)) & path_.startswith(p), F.struct(F.lit(v).alias("verdict"), F.lit(h + p).alias("rule"))) for v, h, p in ranked]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<verdict:string,rule:string>")


def address(url: Column) -> Column:
    """What an alias is looked up by: the address without its fragment, scheme and host in lower case."""
    bare = F.regexp_replace(F.trim(url), r"(?s)#.*$", "")
    front = F.regexp_extract(bare, r"(?s)^(.*?://[^/?#]*)", 1)
    return F.concat(F.lower(front), F.substr(bare, F.length(front) + 1))


def attribute(tag: Column, name: str) -> Column:
    """Value of a tag's first attribute of that name, without quotes; null where it has none."""
    said = F.filter(F.regexp_extract_all(tag, F.lit(r"""[^\s"'<>/=]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s>]+)"""), F.lit(0)), lambda x: x.rlike(rf"(?i)^{name}\s*="))
    return F.regexp_replace(F.regexp_extract(F.get(said, F.lit(0)), r"(?s)^[^=]*=\s*(.*)$", 1), r"""^["']|["']$""", "")


def _dotless(path_: Column) -> Column:
    """A path from the root on, its segments . and .. followed."""
    up = lambda out: F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0)))
    step = lambda out, s: F.when(s == "..", up(out)).when(s == ".", out).otherwise(F.concat(out, F.array(s)))
    ends = F.regexp_replace(F.substr(path_, F.lit(2)), r"(^|/)(\.\.?)$", "$1$2/")
    followed = F.concat(F.lit("/"), F.array_join(F.aggregate(F.split(ends, "/"), F.lit([]).cast("array<string>"), step), "/"))
    return F.when(path_.rlike(r"/\.\.?(/|$)"), followed).otherwise(path_)


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is named once: written out at each use, nested expressions would grow with their product."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def resolve(to: Column, base: Column) -> Column:
    """The address that a target means on a page of address base. Targets with :// stay as they are; empty for those of
    other schemes (mailto:), for empty ones, and for relative ones where base has no ://."""

    def read(x: Column) -> Column:
        to, base = x["to"], x["base"]
        front = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
        here = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
        folder = F.regexp_replace(here, r"[^/]*$", "")
        own = F.regexp_extract(to, r"(?s)^([^?#]*)", 1)
        whole = F.when(to.startswith("/"), own).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), own))
        return (
            F.when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to)
            .when((to == "") | (front == "") | to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), "")
            .when(to.startswith("//"), F.concat(F.regexp_extract(front, r"(?s)^(.*?:)//", 1), to))
            .when(to.startswith("#"), base)
            .when(to.startswith("?"), F.concat(front, here, to))
            .otherwise(F.concat(front, _let(whole, _dotless), F.substr(to, F.length(own) + 1)))
        )

    return _let(F.struct(to.alias("to"), F.coalesce(base, F.lit("")).alias("base")), read)


def links(df: DataFrame, url: str = "url", body: str = "html") -> DataFrame:
    """Columns a and b: canonical links and refresh redirects that pages declare in their HTML. Relative targets are
    resolved against the page's address, or its base element where it has one. Tags in comments are none; pages are read
    whole; null pages and addresses, and an empty table, give no links; repeated rows repeat theirs."""
    page = F.coalesce(df[body].cast("string"), F.lit(""))
    clean = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\t\n\r\f]", ""), "&amp;", "&"))
    # a tag ends at the first > outside its quoted values; a 65th of these would end at the next one
    tag_of = r"""(?is)<(?:{})\b[^>"']*+(?:"[^"]*+"[^>"']*+|'[^']*+'[^>"']*+){{0,64}}[^>]*>"""
    found = lambda names: F.regexp_extract_all("page", F.lit(tag_of.format(names)), F.lit(0))
    shown = df.where(page.rlike(r"(?i)canonical|http-equiv")).select(F.trim(df[url]).alias("u"), F.inline(F.array(F.struct(F.regexp_replace(page, r"(?s)<!--.*?(?:-->|\z)", "").alias("page")))))
    said = shown.select("u", found("link|meta").alias("tags"), found("base").alias("bases"))
    base = F.get(F.filter(F.transform("bases", lambda t: attribute(t, "href")), lambda x: x.isNotNull()), F.lit(0))
    # inline keeps each step apart: as columns the optimizer would write them out at each use
    said = said.select("u", "tags", F.inline(F.array(F.struct(clean(base).alias("base"))))).select("u", "base", F.explode("tags").alias("tag"))
    tag = F.col("tag")
    said = said.select("u", "base", F.inline(F.array(F.struct(*(attribute(tag, x).alias(y) for x, y in (("rel", "rel"), ("href", "href"), ("http-equiv", "equiv"), ("content", "content")))))))
    canonical = F.array_contains(F.split(F.lower(F.coalesce("rel", F.lit(""))), r"\s+"), "canonical")
    later = F.regexp_extract("content", r"""(?is)^\s*(?:[\d.]+\s*[;,\s]\s*(?:url\s*=\s*)?|url\s*=\s*)(.*)$""", 1)
    bare = F.regexp_replace(later, r"""(?s)^(["'])(.*?)(?:\1.*)?$""", "$2")
    target = F.when(canonical, clean(F.col("href"))).when(F.lower(F.trim("equiv")) == "refresh", clean(bare))
    to = said.select("u", "base", F.inline(F.array(F.struct(target.alias("to"))))).where("to != ''")
    based = F.when(F.col("base") == "", F.col("u")).otherwise(_let(resolve(F.col("base"), F.col("u")), lambda b: F.when(b == "", F.col("u")).otherwise(b)))
    out = to.select(address(F.col("u")).alias("a"), F.inline(F.array(F.struct(resolve(F.col("to"), based).alias("b")))))
    return out.select("a", address(F.col("b")).alias("b")).where("a != '' and b != ''")


def judge(df: DataFrame, url: str = "url", body: str | None = "html", redirects: DataFrame | None = None, rules=RULES, default: str = "allow") -> DataFrame:
    """Adds host, path, rule, verdict to df's rows; columns of those names are replaced.

    redirects: optional, columns a and b of addresses that stand for one another. Null addresses and addresses without
    :// have an empty host and path, fit no rule and get the default. A rule decides its own addresses whatever their
    aliases say; among aliases allow goes before block. Repeated rows get one verdict each; an empty table gives no rows;
    other columns keep their names, whatever they are. Pages are read whole whatever their length.
    """
    address_, ruled, alias, said = fresh(df, "address", "ruled", "alias", "said")
    names = {c.lower() for c in ("host", "path", "rule", "verdict")}
    own = [df[c].alias(c) for c in df.columns if c.lower() not in names]
    h, p = host(df[url]), path(df[url])
    edges = links(df, url, body) if body else None
    if redirects is not None:
        more = redirects.select(address(F.col("a")).alias("a"), address(F.col("b")).alias("b"))
        edges = edges.unionByName(more) if edges is not None else more
    # inline keeps the address apart: it may itself be one of the columns that are replaced
    out = df.select(*own, F.inline(F.array(F.struct(h.alias("host"), p.alias("path"), address(df[url]).alias(address_)))))
    out = out.withColumn(ruled, rule_of(F.col("host"), F.col("path"), rules))
    columns = [*(F.col(f"`{c}`") for c in df.columns if c.lower() not in names), F.col("host"), F.col("path"), F.col(f"{ruled}.rule").alias("rule")]
    if edges is None or (joined := components(edges, "a", "b")).isEmpty():
        return out.select(*columns, F.coalesce(f"{ruled}.verdict", F.lit(default)).alias("verdict"))
    verdict = rule_of(host(F.col("node")), path(F.col("node")), rules)["verdict"]
    decided = joined.withColumn("v", verdict).groupBy("component").agg(F.min("v").alias("v"))  # "allow" < "block"
    aliases = joined.join(decided, "component").where("v is not null").select(F.col("node").alias(alias), F.col("v").alias(said))
    out = out.join(aliases, F.col(address_) == F.col(alias), "left")
    return out.select(*columns, F.coalesce(f"{ruled}.verdict", said, F.lit(default)).alias("verdict"))
