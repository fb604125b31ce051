"""Host reputation by empirical Bayes, with explicit rules before it.

Labelled outcomes of pages (good or bad) are counted by host, registered domain and
suffix. The bad share of a host is shrunk to that of its domain, the domain's to
that of its suffix, and the suffix's to the share of all pages, each by a
beta-binomial prior whose strength is fitted by the method of moments. A host is
blocked when a lower bound of its posterior bad share reaches a limit.

The statements below are plain SQL that Spark runs on DataFrames; any SQL engine
gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlake.llm.common import stored

# (host, path prefix, verdict)
Rule = tuple[str, str, str]
# Strengths of a prior are kept within these.
WEAKEST, STRONGEST = "1e0", "1e3"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def parsed_sql(source: str) -> str:
    """page_id, host and path of each url (both empty where there is no host)."""
    rest = "case when instr(url, '://') > 0 then substring(url, instr(url, '://') + 3) else '' end"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""select page_id,
        translate(regexp_extract(rest, '^([^/?#]*)', 1), '{upper}', '{lower}') as host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
      from (select page_id, coalesce({rest}, '') as rest from {source}) as r"""


def carried_sql(source: str) -> str:
    """page_id and doc_id of the document a page carries: the number that ends its path.

    A page without such a number carries none.
    """
    number = "try_cast(nullif(regexp_extract(path, '/([0-9]+)[^/]*/*$', 1), '') as bigint)"
    return f"""select distinct page_id, doc_id
      from (select page_id, {number} as doc_id from ({parsed_sql(source)}) as u) as c
      where doc_id is not null"""


def rule_sql(rules: Sequence[Rule], value: str) -> str:
    """The longest rule that fits: its text or its verdict; else null."""
    if value not in ("rule", "verdict"):
        raise ValueError(value)
    cases = []
    for host, path, verdict in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        end = "." + host
        fits = (
            f"(host = {_text(host)} or right(host, {len(end)}) = {_text(end)})"
            f" and left(path, {len(path)}) = {_text(path)}"
        )
        cases.append(f"when {fits} then {_text(host + path if value == 'rule' else verdict)}")
    return f"case {' '.join(cases)} end" if cases else "cast(null as varchar(1))"


def host_counts_sql(parsed: str, labels: str, long_suffixes: Sequence[str]) -> str:
    """Per host: its domain and suffix, labelled pages, bad pages."""
    known = ", ".join(_text(s) for s in long_suffixes) or "''"
    two = "split_part(host, '.', -2) || '.' || split_part(host, '.', -1)"
    return f"""select host,
        case when instr(host, '.') = 0 then host
             when {two} in ({known}) and length(host) > length({two})
               then split_part(host, '.', -3) || '.' || {two}
             else {two} end as domain,
        case when {two} in ({known}) then {two} else split_part(host, '.', -1) end as suffix,
        n, bad
      from (select p.host, count(l.bad) as n, coalesce(sum(l.bad), 0) as bad
            from {parsed} as p
            left join (select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad
                       from {labels} where quality is not null or toxic is not null
                       group by doc_id) as l
              on p.page_id = l.doc_id
            group by p.host) as h"""


def _strength(counts: str) -> str:
    """Prior strength by the method of moments over the children with labels."""
    mean = f"(select sum(bad) * 1e0 / sum(n) from {counts} where n > 0)"
    return f"""(select case
          when k < 2 or total * total <= squares or mean <= 0 or mean >= 1 then {STRONGEST}
          when spread <= (k - 1) * mean * (1 - mean) then {STRONGEST}
          else greatest({WEAKEST}, least({STRONGEST},
               mean * (1 - mean) * (total - squares / total)
               / (spread - (k - 1) * mean * (1 - mean)) - 1)) end
        from (select count(*) as k, max(mean) as mean, sum(n) * 1e0 as total,
                     sum(n * n) * 1e0 as squares,
                     sum(n * (bad * 1e0 / n - mean) * (bad * 1e0 / n - mean)) as spread
              from (select n, bad, {mean} as mean from {counts} where n > 0) as c) as m)"""


def reputation_sql(counts: str, bound_sds: float) -> str:
    """Per host: posterior mean and lower bound of its bad share."""
    return f"""with suffixes as (select suffix, sum(n) as n, sum(bad) as bad from {counts} group by suffix),
      domains as (select suffix, domain, sum(n) as n, sum(bad) as bad from {counts}
                  group by suffix, domain),
      strengths as (select {_strength("suffixes")} as to_all,
                           {_strength("domains")} as to_suffix,
                           {_strength(counts)} as to_domain,
                           (select (sum(bad) + 5e-1) / (sum(n) + 1e0) from {counts}) as share),
      upper as (select suffix, (bad + (select to_all * share from strengths))
                               / (n + (select to_all from strengths)) as share from suffixes),
      middle as (select d.suffix, d.domain, (d.bad + (select to_suffix from strengths) * u.share)
                        / (d.n + (select to_suffix from strengths)) as share
                 from domains d join upper u on d.suffix = u.suffix),
      posterior as (select c.host, c.n, c.bad,
                           c.bad + (select to_domain from strengths) * m.share as a,
                           c.n - c.bad + (select to_domain from strengths) * (1 - m.share) as b
                    from {counts} c join middle m on c.suffix = m.suffix and c.domain = m.domain)
      select host, n, bad, a / (a + b) as mean,
             a / (a + b) - {bound_sds:e} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as low
      from posterior"""


def judged_sql(parsed: str, reputation: str, rules: Sequence[Rule], limit: float) -> str:
    return f"""select p.page_id, p.host, p.path, p.rule,
        coalesce(p.given, case when r.low >= {limit:e} then 'block' else 'allow' end) as verdict,
        r.mean as bad_mean, r.low as bad_low
      from (select page_id, host, path, {rule_sql(rules, "rule")} as rule,
                   {rule_sql(rules, "verdict")} as given from {parsed}) as p
      left join {reputation} as r on p.host = r.host"""


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[Rule] = (),
    limit: float = 0.5,
    bound_sds: float = 1.645,
    long_suffixes: Sequence[str] = ("co.uk", "com.au", "co.jp", "com.br"),
    carried: DataFrame | None = None,
) -> DataFrame:
    """A verdict for every page: page_id, host, path, rule, verdict, bad_mean, bad_low.

    ``pages`` has page_id and url; ``labels`` has doc_id (the page), quality and toxic,
    where quality 0 or toxic 1 is a bad outcome. Other columns are ignored. Where pages
    have numbers of their own, ``carried`` (page_id, doc_id) says which documents a page
    holds, and the page takes their labels; without it page_id is taken as doc_id.

    A null url, or one without ``://``, has an empty host and path and is judged as
    the host ''. A page with several labels is bad if one is; labels with nulls in
    both outcomes count as none. Hosts without labels carry their prior. Repeated
    pages give repeated rows. Empty tables give an empty result; without labels all
    priors are one half and nothing is blocked below a limit over that.

    Counts combine on the map side, so a host with a third of all pages is one row
    per task; the last join is on the host, and splits when skewed.
    """
    spark = pages.sparkSession
    labels = labels.select("doc_id", "quality", "toxic")
    if carried is not None:
        labels = (
            carried.select("page_id", "doc_id")
            .distinct()
            .join(labels, "doc_id")
            .select(F.col("page_id").alias("doc_id"), "quality", "toxic")
        )
    urls = spark.sql(parsed_sql("{pages}"), pages=pages.select("page_id", "url"))
    counts = stored(
        spark.sql(
            host_counts_sql("{urls}", "{labels}", long_suffixes),
            urls=urls,
            labels=labels,
        ),
        "host-counts",
    )
    reputation = spark.sql(reputation_sql("{counts}", bound_sds), counts=counts)
    return spark.sql(
        judged_sql("{urls}", "{reputation}", rules, limit), urls=urls, reputation=reputation
    )


def oracle_sql(
    rules: Sequence[Rule],
    limit: float = 0.5,
    bound_sds: float = 1.645,
    long_suffixes: Sequence[str] = ("co.uk", "com.au", "co.jp", "com.br"),
) -> str:
    """The same rows by any SQL engine, pages having the labels of what they carry."""
    return f"""with urls as ({parsed_sql("pages")}),
      carried as ({carried_sql("pages")}),
      page_labels as (select c.page_id as doc_id, l.quality, l.toxic
                      from carried as c join labels as l on c.doc_id = l.doc_id),
      counts as ({host_counts_sql("urls", "page_labels", long_suffixes)}),
      reputation as ({reputation_sql("counts", bound_sds)})
      select page_id, host, path, rule, verdict
      from ({judged_sql("urls", "reputation", rules, limit)}) as j"""
