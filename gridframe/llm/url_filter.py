"""URL verdicts by pattern rules that are indexed by their rarest literal token.

Every rule names literal tokens (runs of letters and digits) that any URL it
matches must hold as whole tokens. One pass over the URLs counts in how many of
them each of those tokens occurs; each rule is then filed under its rarest one.
A URL's own tokens fetch its candidate rules, and only those run their regular
expressions. Rules without a literal token are tried on every URL.

Rules are site rules, words of hosts, or patterns over host and path (`glob_rule`), whose literal
tokens are read off the pattern: those runs that neither a wildcard nor an optional part can
lengthen, shorten or leave out.

The rules are configuration, not data: they are broadcast. More than `MAX_RULES` are tried in
blocks of so many, each in a pass over the URLs, and a URL's fits of all blocks meet by its row.

Null URLs and URLs without `://` have an empty host and path and match no site
rule. Repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridframe.llm.common import batch, mapped, texts
from gridframe.shared import written

MAX_RULES = 1_000_000
TOKEN = re.compile(r"[a-z0-9]+")
_LOWER = {i: i + 32 for i in range(65, 91)}


@dataclass(frozen=True)
class Rule:
    """A named regular expression over host + path (site rules, whose beginning fits, and `whole` ones) or over the host alone."""

    name: str
    verdict: str
    pattern: str
    literals: tuple[str, ...]
    site: bool
    whole: bool = False


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """Fits the host and its subdomains where the URL's path begins with `path`."""
    # The path's last token may go on in the URL, unless a mark ends it; so it's no literal token.
    tokens = [*TOKEN.findall(host), *(m[0] for m in TOKEN.finditer(path) if m.end() < len(path))]
    tokens = [t for t in tokens if t == t.lower()]
    return Rule(host + path, verdict, rf"(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}", tuple(dict.fromkeys(tokens)), True)


def host_word_rule(word: str, verdict: str = "block") -> Rule:
    """Fits hosts that hold `word` (tokens joined by single marks) between other marks."""
    return Rule(word, verdict, rf"(?:.*[^a-z0-9])?{re.escape(word)}(?:[^a-z0-9].*)?", tuple(TOKEN.findall(word)), False)


def glob_rule(pattern: str, verdict: str = "block") -> Rule:
    """Fits URLs whose host and path, as a whole, have the form of `pattern`.

    `*` is any run of characters, `?` any one, `[abc]` one of those, `{a,b}` one of those texts (an empty one
    makes it optional), a backslash takes the next character as it is. The part before the first slash
    is lower-cased, as hosts are.
    """
    host, slash, path = pattern.partition("/")
    text, at = host.translate(_LOWER) + slash + path, 0
    regex, known = [], []  # known: literal characters, and None for what isn't one
    while at < len(text):
        c = text[at]
        if c in "*?":
            regex.append(".*" if c == "*" else ".")
            known.append(None)
        elif c in "[{":
            end = text.find("]" if c == "[" else "}", at)
            if end < 0 or (c == "[" and end == at + 1):
                raise ValueError(f"{pattern!r} has no whole {c} at {at}")
            inner = text[at + 1 : end]
            regex.append(f"[{re.escape(inner)}]" if c == "[" else f"(?:{'|'.join(map(re.escape, inner.split(',')))})")
            known.append(None)
            at = end
        else:
            if c == "\\":
                at += 1
                if at == len(text):
                    raise ValueError(f"{pattern!r} ends in a backslash")
            regex.append(re.escape(text[at]))
            known.append(text[at])
        at += 1
    # A run is a whole token of every URL that fits only between literal marks or the ends.
    literals, start = [], 0
    while start < len(known):
        stop = start
        while stop < len(known) and known[stop] is not None and TOKEN.fullmatch(known[stop]):
            stop += 1
        bounded = (start == 0 or known[start - 1] is not None) and (stop == len(known) or known[stop] is not None)
        if stop > start and bounded:
            literals.append("".join(known[start:stop]))
        start = max(stop, start + 1)
    return Rule(pattern, verdict, "".join(regex), tuple(dict.fromkeys(literals)), False, True)


#: The site rules, and words of hosts that are blocked where no site rule fits.
SITES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
HOST_WORDS = ("casino", "casino-win", "spam-farm", "spam", "porn", "xxx", "poker", "viagra", "warez", "clickbait", "malware")
DEFAULT_RULES = (*(site_rule(*s) for s in SITES), *(host_word_rule(w) for w in HOST_WORDS))


def parts(url: str) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty without `://`."""
    _, mark, rest = url.partition("://")
    if not mark:
        return "", ""
    rest = re.split(r"[?#]", rest, maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


def url_tokens(host: str, path: str) -> set[str]:
    """Whole tokens of host and path; the path's case counts, so its capital letters end tokens."""
    return {*TOKEN.findall(host), *TOKEN.findall(path)}


_LITERALS = T.StructType([T.StructField("token", T.StringType()), T.StructField("n", T.LongType())])


def token_frequency(urls: DataFrame, tokens: set[str]) -> dict[str, int]:
    """In how many of the URLs each of the rules' tokens occurs. Tasks count, then their counts are summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = dict.fromkeys(tokens, 0)
        for b in batches:
            for url in texts(b.column(0)):
                for t in url_tokens(*parts(url)) & tokens:
                    seen[t] += 1
        found = {t: n for t, n in seen.items() if n}
        yield batch(_LITERALS, list(found), list(found.values()))

    return {r["token"]: r["n"] for r in mapped(urls, count, _LITERALS).groupBy("token").agg(F.sum("n").alias("n")).collect()}


def indexed(rules: tuple[Rule, ...], frequency: dict[str, int]) -> tuple[dict[str, list[int]], list[int]]:
    """Rule numbers by their rarest literal token, and those of rules without one."""
    by_token: dict[str, list[int]] = {}
    always = []
    for k, rule in enumerate(rules):
        if rule.literals:
            by_token.setdefault(min(rule.literals, key=lambda t: (frequency.get(t, 0), t)), []).append(k)
        else:
            always.append(k)
    return by_token, always


def _fits(rule: Rule, compiled: re.Pattern, host: str, path: str) -> bool:
    if rule.site:
        return compiled.match(host + path) is not None
    return compiled.fullmatch(host + path if rule.whole else host) is not None


def judge(urls: DataFrame, rules: tuple[Rule, ...] = DEFAULT_RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per URL: page_id, host, path, rule (the longest site rule that fits), verdict, pattern_rules (all others that fit).

    The verdict is the site rule's; without one, `block` if any other rule that fits blocks, else `allow`.
    """
    urls = urls.select(urls[id_col].alias("page_id"), urls[url_col].alias("url"))
    if len(rules) <= MAX_RULES:
        return _judged(urls, rules).drop("word_blocks")
    rows = written(urls.select(F.struct("page_id", F.monotonically_increasing_id().alias("row")).alias("page_id"), "url"), "urls")
    found = [_judged(rows, rules[at : at + MAX_RULES]).withColumn("block", F.lit(at)) for at in range(0, len(rules), MAX_RULES)]
    fits = found[0]
    for more in found[1:]:
        fits = fits.unionByName(more)
    # The longest site rule of all blocks; of equal ones the first, as within a block.
    site = F.max(F.when(F.col("rule").isNotNull(), F.struct(F.length("rule").alias("length"), (-F.col("block")).alias("earlier"), "rule", "verdict")))
    listed = F.array_sort(F.collect_list(F.when(F.col("pattern_rules") != "", F.struct("block", "pattern_rules"))))
    by_row = fits.groupBy("page_id", "host", "path").agg(site.alias("site"), F.max("word_blocks").alias("words"), listed.alias("listed"))
    verdict = F.coalesce("site.verdict", F.when(F.col("words"), "block").otherwise("allow"))
    return by_row.select("page_id.page_id", "host", "path", "site.rule", verdict.alias("verdict"), F.array_join(F.transform("listed", lambda x: x["pattern_rules"]), ",").alias("pattern_rules"))


def _judged(urls: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    spark = urls.sparkSession
    frequency = token_frequency(urls.select("url"), {t for r in rules for t in r.literals})
    shared = spark.sparkContext.broadcast((rules, *indexed(rules, frequency)))
    schema = T.StructType([urls.schema["page_id"], *(T.StructField(n, T.StringType()) for n in ("host", "path", "rule", "verdict", "pattern_rules")), T.StructField("word_blocks", T.BooleanType())])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules, by_token, always = shared.value
        compiled = [re.compile(r.pattern, re.DOTALL) for r in rules]
        for b in batches:
            rows = []
            for url in texts(b.column(1)):
                host, path = parts(url)
                candidates = {k for t in url_tokens(host, path) for k in by_token.get(t, ())}.union(always)
                fits = [rules[k] for k in sorted(candidates) if _fits(rules[k], compiled[k], host, path)]
                site = max((r for r in fits if r.site), key=lambda r: len(r.name), default=None)
                words = [r for r in fits if not r.site]
                blocked = any(r.verdict == "block" for r in words)
                verdict = site.verdict if site else "block" if blocked else "allow"
                rows.append((host, path, site and site.name, verdict, ",".join(r.name for r in words), blocked))
            yield batch(schema, b.column(0), *(list(zip(*rows, strict=True)) or [[]] * 6))

    return mapped(urls, apply, schema)


def _oracle() -> str:
    """The same by SQL: every default rule tried on every URL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    sites = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in SITES)
    words = " OR ".join(f"regexp_full_match(host, '(.*[^a-z0-9])?{re.escape(w)}([^a-z0-9].*)?', 's')" for w in HOST_WORDS)
    listed = " || ".join(f"CASE WHEN regexp_full_match(host, '(.*[^a-z0-9])?{re.escape(w)}([^a-z0-9].*)?', 's') THEN '{w},' ELSE '' END" for w in HOST_WORDS)
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages
), part AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), '{upper}', '{lower}') AS host, substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path FROM cut
), rules(rule_host, rule_path, rule_verdict) AS (VALUES {sites}
), best AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
  FROM part JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id
)
SELECT part.page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN {words} THEN 'block' ELSE 'allow' END) AS verdict, rtrim({listed}, ',') AS pattern_rules
FROM part LEFT JOIN best ON part.page_id = best.page_id
"""


ORACLE = _oracle()
