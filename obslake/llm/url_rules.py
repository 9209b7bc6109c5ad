"""URL filters: pattern rules indexed by their rarest literal token.

Two kinds of rules judge a page's URL.

* Host rules ``(verdict, host, path)``: a rule fits a URL whose host is the rule's host or one of its
  subdomains and whose path starts with the rule's path; of the fitting rules the longest
  (``host + path``, then the larger text) decides. They are indexed by host: the URL's host suffixes
  at dot borders are looked up in a map, so a URL meets only rules of its own host suffixes.
* Pattern rules in the usual filter-list syntax decide URLs that no host rule fits: ``||`` anchors a
  host (any subdomain), ``|`` the start or end, ``*`` is any text, ``^`` a separator or the end, a
  leading ``@@`` makes an exception that allows. Each rule is indexed under one literal token that
  any URL it matches must hold as a whole token (letters and digits between a separator, an anchor
  or a fixed non-token character); of its tokens the one that the fewest page URLs hold, counted over
  all pages, is chosen. A URL's tokens fetch the rules indexed under them, and only those run their
  regular expression; rules without such a token are run on every URL, so no match is lost.
  Verdict: ``allow`` if an exception matches, else ``block`` if a blocking rule matches, else
  ``allow``.

The judgement is one projection of each row: no shuffle, no join. Counting the tokens is one
aggregation of the rule tokens only, whose result is as large as the rule list.

Host: the text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased;
path: from there up to ``?``, ``#`` or the end. A null URL or one without ``://`` has both empty
(it fits no host rule, and no pattern rule runs on a null URL: allow). Empty and very long URLs are
judged whole. Repeated rows are judged alike. Other columns of the input are ignored; the result
has page_id, host, path, rule (``host + path`` of the deciding host rule or null), verdict, pattern
(the first matching pattern rule in list order, null when a host rule decides or none matches) and
n_candidates (pattern rules run on the URL).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the task: host rules as (verdict, host, path), in the order given.
HOST_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]

#: Default pattern rules: advertising and tracking hosts, ad paths, session and login pages, spam words.
PATTERN_RULES = [
    "||ads-track.",
    "||doubleclick.",
    "||adservice.",
    "||tracker.",
    "/ads/",
    "/banner/*.gif",
    "/popup.",
    "?sessionid=",
    "&sessionid=",
    "/wp-login.php",
    "/cart^",
    "/checkout^",
    "utm_source=spam",
    "casino",
    "@@||blog.*/en/about",
]

TOKEN = "[a-z0-9]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# a separator: anything but a letter, a digit or one of _ - . %
_SEPARATOR = "(?:[^a-z0-9_.%-]|\\z)"
_SPECIAL = set(".?+*()[]{}|\\^$")
_HOST_START = "^[a-z][a-z0-9+.-]*://(?:[^/?#]*\\.)?"
_RULES = "array<struct<length:int,rule:string,verdict:string,path:string>>"


@dataclass(frozen=True)
class Rule:
    text: str
    allow: bool
    regex: str
    tokens: tuple[str, ...]


def parse_rule(text: str) -> Rule:
    """A pattern rule: its regular expression and the literal tokens that every match holds whole."""
    allow = text.startswith("@@")
    body = text[2:] if allow else text
    head = "host" if body.startswith("||") else "start" if body.startswith("|") else ""
    body = body[len(head == "host" and "||" or head == "start" and "|" or ""):]
    tail = body.endswith("|")
    body = body[:-1] if tail else body
    regex = [_HOST_START if head == "host" else "^" if head == "start" else ""]
    tokens, pieces = [], re.split(r"([*^])", body)
    for k, piece in enumerate(pieces):
        if piece == "*":
            regex.append(".*")
        elif piece == "^":
            regex.append(_SEPARATOR)
        else:
            regex.append("".join("\\" + c if c in _SPECIAL else c for c in piece))
            for m in re.finditer(TOKEN, piece.lower()):
                left = m.start() > 0 or (k == 0 and head != "") or (k > 0 and pieces[k - 1] == "^")
                right = m.end() < len(piece) or (k == len(pieces) - 1 and tail) or (
                    k + 1 < len(pieces) and pieces[k + 1] == "^")
                if left and right:
                    tokens.append(m.group())
    if tail:
        regex.append("\\z")
    return Rule(text, allow, "(?i)" + "".join(regex), tuple(dict.fromkeys(tokens)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, url.substr(at + 3, F.length(url))), F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return host, path


def _host_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting host rule as struct(length, rule, verdict), or null."""
    by_host: dict[str, list] = {}
    for verdict, rule_host, rule_path in rules:
        by_host.setdefault(rule_host, []).append(F.struct(
            F.lit(len(rule_host + rule_path)).alias("length"), F.lit(rule_host + rule_path).alias("rule"),
            F.lit(verdict).alias("verdict"), F.lit(rule_path).alias("path")))
    index = F.create_map(*[x for h, rs in by_host.items() for x in (F.lit(h), F.array(*rs))])
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels) - k + 1), "."))
    found = F.flatten(F.transform(suffixes, lambda s: F.coalesce(F.try_element_at(index, s), F.array().cast(_RULES))))
    fitting = F.filter(found, lambda r: F.startswith(path, r["path"]))
    return F.array_max(F.transform(fitting, lambda r: F.struct(r["length"], r["rule"], r["verdict"])))


def token_counts(pages: DataFrame, rules: list[Rule], url: str = "url") -> dict[str, int]:
    """How many URLs hold each token of the rules, over all pages (as many rows as rule tokens)."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    tokens = F.array_distinct(F.regexp_extract_all(F.lower(F.col(url)), F.lit(TOKEN), 0))
    counted = (pages.select(F.explode(tokens).alias("token"))
               .filter(F.col("token").isin(wanted)).groupBy("token").count())
    found = {r["token"]: r["count"] for r in counted.collect()}
    return {t: found.get(t, 0) for t in wanted}


def index_rules(rules: list[Rule], counts: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """(token -> rules indexed under it, rules without a token): each rule under its rarest token."""
    index: dict[str, list[int]] = {}
    rest = []
    for i, rule in enumerate(rules):
        if rule.tokens:
            rarest = min(rule.tokens, key=lambda t: (counts.get(t, 0), t))
            index.setdefault(rarest, []).append(i)
        else:
            rest.append(i)
    return index, rest


def judge_urls(
    pages: DataFrame, patterns: list[str] = PATTERN_RULES, host_rules: list[tuple[str, str, str]] = HOST_RULES,
    url: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict, pattern, n_candidates of every page; see the module."""
    rules = [parse_rule(p) for p in patterns]
    index, rest = index_rules(rules, token_counts(pages, rules, url))
    rows = pages.select(F.col("page_id"), F.col(url).alias("__url"))
    u = F.col("__url")
    host, path = host_and_path(u)
    tokens = F.coalesce(F.array_distinct(F.regexp_extract_all(F.lower(u), F.lit(TOKEN), 0)), F.array())
    empty = F.array().cast("array<int>")
    if index:
        lookup = F.create_map(*[x for t, ids in index.items() for x in (F.lit(t), F.array(*map(F.lit, ids)))])
        fetched = F.flatten(F.transform(tokens, lambda t: F.coalesce(F.try_element_at(lookup, t), empty)))
    else:
        fetched = empty
    candidates = F.array_sort(F.array_distinct(F.concat(fetched, F.array(*map(F.lit, rest)).cast("array<int>"))))
    candidates = F.when(u.isNull(), empty).otherwise(candidates)

    def runs(r: Column) -> Column:
        test = None
        for i, rule in enumerate(rules):
            hit = u.rlike(rule.regex)
            test = F.when(r == i, hit) if test is None else test.when(r == i, hit)
        return test.otherwise(F.lit(False)) if test is not None else F.lit(False)

    judged = rows.select(
        "page_id", "__url", host.alias("host"), path.alias("path"), candidates.alias("_cand"))
    judged = judged.select(
        "page_id", "host", "path", F.size("_cand").alias("n_candidates"),
        F.filter("_cand", runs).alias("_hits"), _host_rule(F.col("host"), F.col("path"), host_rules).alias("_rule"))
    allow_ids = [i for i, r in enumerate(rules) if r.allow]
    texts = F.array(*[F.lit(r.text) for r in rules]) if rules else F.array().cast("array<string>")
    excepted = F.exists("_hits", lambda r: r.isin(allow_ids)) if allow_ids else F.lit(False)
    by_pattern = F.when(excepted, "allow").when(F.size("_hits") > 0, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), by_pattern).alias("verdict"),
        F.when(F.col("_rule").isNull() & (F.size("_hits") > 0),
               F.element_at(texts, F.element_at("_hits", 1) + 1)).alias("pattern"),
        F.col("n_candidates").cast("long").alias("n_candidates"))


def brute_force_sql(patterns: list[str] = PATTERN_RULES, host_rules: list[tuple[str, str, str]] = HOST_RULES) -> str:
    """DuckDB SQL with the result of ``judge_urls``: every URL against every rule, without the index."""
    def text(v: str) -> str:
        return "'" + v.replace("'", "''") + "'"
    hosts = ", ".join(f"({text(v)}, {text(h)}, {text(p)})" for v, h, p in host_rules)
    rules = [parse_rule(p) for p in patterns]
    pats = ", ".join(f"({i}, {str(r.allow).lower()}, {text(r.regex)}, {text(r.text)})" for i, r in enumerate(rules))
    return f"""
WITH p AS (SELECT row_number() OVER () AS rid, page_id, url,
                  CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
           FROM pages),
h AS (SELECT rid, page_id, url, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*', 0), '{_UPPER}', '{_LOWER}') AS host,
             regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r(verdict, rhost, rpath) AS (VALUES {hosts}),
fit AS (SELECT rid, max(struct_pack(l := length(rhost || rpath), rule := rhost || rpath, verdict := verdict)) AS best
        FROM h JOIN r ON (h.host = r.rhost OR suffix(h.host, '.' || r.rhost)) AND starts_with(h.path, r.rpath)
        GROUP BY rid),
pat(i, allow, rx, txt) AS (VALUES {pats}),
hits AS (SELECT rid, bool_or(allow) AS excepted, count(*) AS n, min(i) AS first
         FROM h JOIN pat ON regexp_matches(h.url, pat.rx) GROUP BY rid)
SELECT h.page_id, h.host, h.path, fit.best.rule AS rule,
       coalesce(fit.best.verdict, CASE WHEN hits.excepted THEN 'allow' WHEN hits.n > 0 THEN 'block' ELSE 'allow' END)
           AS verdict,
       CASE WHEN fit.best IS NULL AND hits.n > 0 THEN (SELECT txt FROM pat WHERE pat.i = hits.first) END AS pattern
FROM h LEFT JOIN fit USING (rid) LEFT JOIN hits USING (rid)"""
