"""URL filter: host/path rules first, then a weighted URL vocabulary.

The vocabulary has strict and soft terms with weights.  An Aho-Corasick
automaton finds every term in the ASCII-lower-cased url in one pass; a hit
counts only between boundaries (neither neighbour is a letter or digit a-z,
0-9).  A url is blocked on one strict hit, or on ``min_soft`` distinct soft
hits.  A fitting rule overrides the vocabulary; the longest rule wins, and
of equal rules the blocking one.

Defined results: a null url or one without ``://`` has an empty host and
path and fits no rule; a null url is allowed, any other text is still
scanned.  Rows are judged one by one, so repeated rows repeat their verdict,
an empty table gives an empty result, and other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import batches_of, ship_package

STRICT = {"adult": 1.0, "casino": 1.0, "cialis": 1.0, "escort": 1.0, "gambling": 1.0, "hentai": 1.0, "malware": 1.0,
          "phishing": 1.0, "porn": 1.0, "spam": 1.0, "viagra": 1.0, "warez": 1.0, "xxx": 1.0}
SOFT = {"ads": 0.5, "bet": 0.5, "bets": 0.5, "bonus": 0.4, "cam": 0.4, "cheap": 0.5, "dating": 0.4, "discount": 0.3,
        "free": 0.3, "jackpot": 0.6, "loan": 0.4, "loans": 0.4, "nude": 0.6, "pills": 0.6, "poker": 0.6,
        "replica": 0.4, "slots": 0.5, "track": 0.3, "tracker": 0.4, "win": 0.3}
#: (verdict, host[/path]) rules of the contract.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))

_UPPER = {c: c + 32 for c in range(65, 91)}
_ALNUM = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) by the contract's rules."""
    at = -1 if url is None else url.find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
    host, path = rest[:cut].translate(_UPPER), rest[cut:]
    end = min([i for i in map(path.find, "?#") if i >= 0], default=len(path))
    return host, path[:end]


class UrlFilter:
    """Rules and vocabulary compiled for one Python worker."""

    def __init__(self, rules, strict, soft, min_soft):
        self.by_host: dict[str, list[tuple[str, str, str]]] = {}
        for verdict, rule in rules:
            host, slash, path = rule.partition("/")
            self.by_host.setdefault(host, []).append((slash + path, rule, verdict))
        self.min_soft = min_soft
        self.auto = ahocorasick.Automaton()
        for kind, terms in (("soft", soft), ("strict", strict)):
            for term, weight in terms.items():
                self.auto.add_word(term, (kind, term, weight))
        if strict or soft:
            self.auto.make_automaton()

    def rule(self, host: str, path: str) -> tuple[str, str] | None:
        best, labels = None, host.split(".")
        for i in range(len(labels)):
            for prefix, rule, verdict in self.by_host.get(".".join(labels[i:]), ()):
                if path.startswith(prefix) and (best is None or (len(rule), verdict) > (len(best[0]), best[1])):
                    best = rule, verdict
        return best

    def hits(self, url: str | None) -> dict[str, tuple[str, float]]:
        """Distinct terms with boundaries on both sides: term -> (kind, weight)."""
        text, found = (url or "").translate(_UPPER), {}
        if text and len(self.auto):
            for end, (kind, term, weight) in self.auto.iter(text):
                start = end - len(term) + 1
                if (start == 0 or text[start - 1] not in _ALNUM) and (end + 1 == len(text) or text[end + 1] not in _ALNUM):
                    found[term] = kind, weight
        return found

    def judge(self, url: str | None) -> tuple:
        host, path = split_url(url)
        found = self.hits(url)
        n_strict = sum(k == "strict" for k, _ in found.values())
        n_soft = len(found) - n_strict
        rule = self.rule(host, path) if host else None
        own = "block" if n_strict or n_soft >= self.min_soft else "allow"
        score = round(sum(found[t][1] for t in sorted(found)), 6)
        return host, path, rule[0] if rule else None, rule[1] if rule else own, n_strict, n_soft, score


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: Sequence = RULES,
               strict: dict = STRICT, soft: dict = SOFT, min_soft: int = 2) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, n_strict, n_soft (distinct terms) and their weight."""
    ship_package(pages.sparkSession)
    schema = (f"{id_col} bigint, host string, path string, rule string, verdict string, n_strict bigint, "
              "n_soft bigint, weight double")
    kinds = [pa.int64(), *[pa.string()] * 4, pa.int64(), pa.int64(), pa.float64()]
    names = [id_col, "host", "path", "rule", "verdict", "n_strict", "n_soft", "weight"]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f, out = UrlFilter(rules, strict, soft, min_soft), []
        for key, url in batches_of(rows, "_id", "_url"):
            out.append((key, *f.judge(url)))
            if len(out) == 4096:
                yield _batch(out, kinds, names)
                out = []
        if out:
            yield _batch(out, kinds, names)

    return pages.select(F.col(id_col).cast("long").alias("_id"), F.col(url_col).alias("_url")).mapInArrow(run, schema)


def _batch(rows: list[tuple], kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def oracle(rules: Sequence = RULES, strict: dict = STRICT, soft: dict = SOFT, min_soft: int = 2) -> str:
    """The same verdicts in DuckDB SQL over ``pages``."""
    low = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def count(terms):
        return " + ".join(f"regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::BIGINT" for t in terms) or "0::BIGINT"

    def weigh(terms):
        return " + ".join(f"{w!r} * regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::BIGINT" for t, w in terms)

    fits = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[0] != "block")):
        host, slash, path = rule.partition("/")
        fits.append((f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash + path}')", rule, verdict))
    rule_case = " ".join(f"WHEN {f} THEN '{r}'" for f, r, _ in fits)
    verdict_case = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits)
    return f"""
WITH a AS (SELECT page_id, coalesce({low.format('url')}, '') AS u,
    CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, u, {low.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
    regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM a),
c AS (SELECT *, {count(strict)} AS n_strict, {count(soft)} AS n_soft, {weigh(list({**strict, **soft}.items()))} AS w FROM b)
SELECT page_id, host, path, CASE WHEN host = '' THEN NULL {rule_case} END AS rule,
    CASE WHEN host = '' THEN CASE WHEN n_strict > 0 OR n_soft >= {min_soft} THEN 'block' ELSE 'allow' END {verdict_case}
         WHEN n_strict > 0 OR n_soft >= {min_soft} THEN 'block' ELSE 'allow' END AS verdict,
    n_strict, n_soft, round(w::DOUBLE, 6) AS weight FROM c"""
