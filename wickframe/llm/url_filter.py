"""URL verdicts from rules and a tree of path templates.

Rules (host, path prefix) decide where they fit; the longest wins. Every other URL is judged by its
template. Per host, a path is cut into segments; segments with digits or of great length become wildcards. Then the
tree is walked from the root until no path has a further segment: below each node, branches whose share of blocked pages
does not differ significantly from their siblings' are merged into one branch ``**``, however many branches there are (rare
ones, as variable segments make them, do not differ significantly). Unlabelled pages count in this test, so a branch that no
rule speaks of does not join a branch that a rule blocks. Each template's purity is blocked / (blocked + allowed by a rule),
smoothed by the blocked share of all pages of the host; templates of at least ``PURE`` are rejected, and one without a labelled page has
no purity (null) and is allowed.
Only counts per (host, path shape) are walked, and pages are joined with the verdicts once. A step passes over all segments that the
paths of a branch share, so the steps are as many as levels with a choice, not as the longest path has segments.

Nulls, ties and edge cases: a null URL, or one without "://", has an empty host and path and a template of its own;
of rules of equal length the one with the longer host, then the first in order, wins; URLs that repeat count each
time; an empty table gives no rows. Columns besides the id and the URL are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickframe.llm.common import cut, table

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
LONG = 24  # characters from which a segment is variable
Z2 = 3.841  # square of the normal deviate at 5 %
WEIGHT = 10.0  # labelled pages that the host's share counts as
PURE = 0.5
MERGED = "**"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and action of the longest fitting rule, null where none fits."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, h, p in reversed(ordered):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, action = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(verdict)).otherwise(action)
    return name, action


def path_shape(path: Column) -> Column:
    """Segments of a path with the evidently variable ones as wildcards (file endings stay)."""
    def shape(s: Column) -> Column:
        ending = F.regexp_extract(s, r"(\.[A-Za-z]{1,5})$", 1)
        return F.when(s.rlike("[0-9]") | (F.length(s) >= LONG), F.concat(F.lit("*"), ending)).otherwise(s)

    parts = F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), shape)
    return F.concat_ws("/", parts)


def shared_start(a: str, b: str) -> Column:
    """Number of leading elements that two arrays share."""
    first_other = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), F.lit(False))
    return F.when(first_other == 0, F.size(a)).otherwise(first_other - 1).cast("int")


def template_tree(counts: DataFrame) -> DataFrame:
    """(host, shape, n, blocked, allowed) -> the same rows with their template."""
    parts = F.filter(F.split("shape", "/"), lambda s: s != "")
    pending, done = cut(counts.withColumns({"_rest": parts, "template": F.lit("")})), []
    while True:
        now = pending.withColumn("_seg", F.coalesce(F.get("_rest", F.lit(0)), F.lit("")))
        branch = now.groupBy("host", "template", "_seg").agg(
            F.sum("n").alias("_n"), F.sum("blocked").alias("_b"), F.min("_rest").alias("_lo"), F.max("_rest").alias("_hi")
        )
        parent = branch.groupBy("host", "template").agg(
            F.sum("_n").alias("_pn"), F.sum("_b").alias("_pb"), F.count_if(F.col("_seg") != "").alias("_children")
        )
        n, b, pn, pb = (F.col(c).cast("double") for c in ("_n", "_b", "_pn", "_pb"))
        off = b * (pn - n) - (pb - b) * n
        alike = off * off * pn < F.lit(Z2) * pb * (pn - pb) * n * (pn - n)
        uniform = (F.col("_pb") == 0) | (F.col("_pb") == F.col("_pn"))
        merge = (F.col("_seg") != "") & (F.col("_children") > 1) & (uniform | alike)
        steps = branch.join(parent, ["host", "template"]).withColumn("_taken", F.when(merge, F.lit(1)).otherwise(shared_start("_lo", "_hi")))
        steps = steps.select(
            "host",
            "template",
            "_seg",
            "_taken",
            F.when(merge, F.lit(MERGED)).otherwise(F.concat_ws("/", F.slice("_lo", F.lit(1), F.col("_taken")))).alias("_as"),
            ((F.col("_seg") == "") | (~merge & (F.col("_lo") == F.col("_hi")))).alias("_done"),
        )
        now = now.join(steps, ["host", "template", "_seg"]).withColumns(
            {
                "template": F.when(F.col("_as") == "", F.col("template")).otherwise(F.concat_ws("/", "template", "_as")),
                "_rest": F.slice("_rest", F.col("_taken") + 1, F.size("_rest")),
            }
        )
        now = cut(now.select(*pending.columns, "_done"))
        done.append(now.filter("_done").drop("_rest", "_done"))
        pending = now.filter("not _done").drop("_done")
        if pending.isEmpty():
            return reduce(DataFrame.unionByName, done)


def template_verdicts(tree: DataFrame) -> DataFrame:
    """(host, shape, template, purity, template_verdict)."""
    templates = tree.groupBy("host", "template").agg(F.sum("n").alias("_n"), F.sum("blocked").alias("_b"), F.sum("allowed").alias("_a"))
    hosts = templates.groupBy("host").agg((F.sum("_b").cast("double") / F.sum("_n").cast("double")).alias("_share"))
    labelled = (F.col("_a") + F.col("_b")).cast("double")
    purity = F.when(labelled > 0, (F.col("_b").cast("double") + F.lit(WEIGHT) * F.col("_share")) / (labelled + F.lit(WEIGHT)))
    judged = templates.join(hosts, "host").select("host", "template", purity.alias("purity"))
    verdict = F.when(F.col("purity") >= PURE, "block").otherwise("allow")
    return tree.select("host", "shape", "template").join(judged, ["host", "template"]).withColumn("template_verdict", verdict)


def judge_urls(pages: DataFrame, id_column: str = "page_id", rules=RULES) -> DataFrame:
    """Id, host, path, rule, template, purity and verdict of every URL."""
    host, path = split_url(F.col("url"))
    parsed = pages.select(F.col(id_column), host.alias("host"), path.alias("path"))
    name, action = matching_rule(F.col("host"), F.col("path"), rules)
    parsed = parsed.withColumns({"rule": name, "_action": action, "shape": path_shape(F.col("path"))})
    counts = parsed.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("_action") == action).alias(name) for action, name in (("block", "blocked"), ("allow", "allowed"))]
    )
    found = template_verdicts(template_tree(counts))
    return parsed.join(found, ["host", "shape"]).select(
        id_column, "host", "path", "rule", F.coalesce("_action", "template_verdict").alias("verdict"), "template", F.round("purity", 9).alias("purity")
    )


def op6_url_filter(spark, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def url_filter_sql() -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1])))
    fits = [(f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')", h + p, v) for v, h, p in ordered]
    rule = "case " + " ".join(f"when {c} then '{n}'" for c, n, _ in fits) + " end"
    action = "case " + " ".join(f"when {c} then '{v}'" for c, _, v in fits) + " end"
    return f"""
 with recursive r as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
 h as (select *, regexp_extract(rest, '^([^/?#]*)', 1) as raw from r),
 q as (select page_id, translate(raw, '{UPPER}', '{LOWER}') as host,
              regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1) as path from h),
 a as (select *, {rule} as rule, {action} as action,
   list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s: case when regexp_matches(s, '[0-9]') or length(s) >= {LONG}
     then '*' || regexp_extract(s, '(\\.[A-Za-z]{{1,5}})$', 1) else s end) as parts from q),
 d as (select * exclude (parts), array_to_string(parts, '/') as shape from a),
 t as (select host, shape, count(*) as n, count(*) filter (action = 'block') as blocked, count(*) filter (action = 'allow') as allowed,
     list_filter(string_split(shape, '/'), lambda s: s <> '') as parts, 0 as level, '' as template, false as done
   from d group by host, shape
   union all
   select host, shape, n, blocked, allowed, parts, level + 1,
     case when seg = '' then template when children > 1 and (pb = 0 or pb = pn
       or (b * (pn - n0) - (pb - b) * n0) * (b * (pn - n0) - (pb - b) * n0) * pn < {Z2} * pb * (pn - pb) * n0 * (pn - n0))
       then template || '/{MERGED}' else template || '/' || seg end, seg = ''
   from (select *, sum(n) over w::double as n0, sum(blocked) over w::double as b, sum(n) over v::double as pn, sum(blocked) over v::double as pb,
           count(distinct nullif(seg, '')) over v as children
         from (select *, coalesce(parts[level + 1], '') as seg from t where not done)
         window w as (partition by host, template, seg), v as (partition by host, template))),
 tree as (select host, shape, n, blocked, allowed, template from t where done),
 tt as (select host, template, sum(n)::double as n, sum(blocked)::double as b, sum(allowed)::double as a from tree group by all),
 hh as (select host, sum(b) / sum(n) as share from tt group by all),
 jj as (select host, template, case when a + b > 0 then (b + {WEIGHT} * share) / (a + b + {WEIGHT}) end as purity from tt join hh using (host))
 select d.page_id, d.host, d.path, d.rule, coalesce(d.action, case when jj.purity >= {PURE} then 'block' else 'allow' end) as verdict,
        tree.template, round(jj.purity, 9) as purity
 from d join tree using (host, shape) join jj using (host, template)"""


SQL = {"op6_url_filter": url_filter_sql()}
