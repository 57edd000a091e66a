"""URL filters: one bit-parallel wildcard automaton for all rules.

Method: every glob is cut into its literal bytes; one state bit stands for each place
in each glob, all packed into words of 64 bits.  A step of the Shift-And recurrence,

    state = ((state << 1) & may_enter[byte]) | (state & may_stay[byte]),

moves all globs at once over a byte of the canonical URL (host with A-Z lower-cased,
then path); carries run from word to word.  ``*`` stands for any run without ``/``,
``**`` for any run, ``?`` for one byte other than ``/``.  As many URLs take their steps together
as their states fit in STATE_BYTES, so more globs need more time but no more memory.

A rule (action, host, path) fits its host and all subdomains if the URL's path starts
with the rule's; it becomes two globs.  The longest fitting rule decides; without one,
a URL is blocked if any block glob matches and allowed otherwise.

Rules and globs are lists, or tables of at most MAX_GLOBS rows, which are read on the driver.

Defined results: null URLs and URLs without ``://`` have an empty host and path, fit no
rule and are allowed unless a glob matches the empty string; URLs of any length are matched whole;
of rules of equal length the first stated decides (in a table, the first in order of path, host and
action); repeated rows each get a row; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import textkit as K

#: The rules of the contract query, as (action, host, path).
RULES = [("block", "com", "/en/"), ("allow", "example.com", "/en/7"), ("allow", "net", "/de/"), ("block", "example.net", "/de/8"), ("block", "org", "/es/")]
#: Words that tell of advertising, gambling, adult or malicious hosts, in natural order, and the
#: globs that block a host with one of them when no rule decides.
BLOCK_WORDS = ["adult-", "affiliate-", "bet-online", "casino", "cheap-", "clickbait", "coupon-", "download-free", "escort", "free-money", "gambling", "keygen", "lottery", "malware", "payday-loan", "phishing", "pills-", "poker-", "porn", "replica-", "slots-", "spam-", "torrent-", "viagra", "warez", "win-prize", "xxx-"]
BLOCK_GLOBS = [f"*{word}*{rest}" for word in BLOCK_WORDS for rest in ("/**", "")]
#: Rows that a table of rules or globs may have, and bytes of the states of URLs that step together.
MAX_GLOBS = 200_000
STATE_BYTES = 32 << 20


class Automaton:
    """Globs packed into multiword Shift-And masks."""

    def __init__(self, globs: list[str]):
        places: list[tuple[object, str]] = []  # (what may enter: None, a byte or "?"; what may stay: "", "*" or "**")
        self.last = []
        for glob in globs:
            rest, literal, stay = glob.encode(), None, ""
            while rest:
                stars = len(rest) - len(rest.lstrip(b"*"))
                if rest[:1] == b"\\" and len(rest) > 1:  # the byte behind stands for itself
                    places.append((literal, stay))
                    literal, stay, rest = rest[1], "", rest[2:]
                elif stars:
                    stay = "**" if stars > 1 or stay == "**" else "*"
                    rest = rest[stars:]
                else:
                    places.append((literal, stay))
                    literal, stay, rest = ("?" if rest[:1] == b"?" else rest[0]), "", rest[1:]
            places.append((literal, stay))
            self.last.append(len(places) - 1)
        n_words = max(1, -(-len(places) // 64))
        # masks by kinds of bytes: each literal byte, the slash, and all others
        literals = sorted({x for x, _ in places if isinstance(x, int)} | {ord("/")})
        self.kind = np.zeros(256, dtype=np.intp)
        self.kind[literals] = np.arange(1, len(literals) + 1)
        kinds = np.arange(len(literals) + 1)
        self.enter = np.zeros((len(kinds), n_words), dtype=np.uint64)
        self.stay = np.zeros((len(kinds), n_words), dtype=np.uint64)
        self.begin = np.zeros(n_words, dtype=np.uint64)
        plain = kinds != self.kind[ord("/")]
        for at, (literal, stay) in enumerate(places):
            word, bit = at // 64, np.uint64(1) << np.uint64(at % 64)
            if literal is None:
                self.begin[word] |= bit
            elif literal == "?":
                self.enter[plain, word] |= bit
            else:
                self.enter[self.kind[literal], word] |= bit
            if stay:
                self.stay[kinds if stay == "**" else plain, word] |= bit
        self.last = np.array(self.last, dtype=np.int64)

    def run(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Which globs match each whole string: (strings, globs)."""
        length = np.diff(offs)
        order = np.argsort(-length, kind="stable")
        start, descending = offs[:-1][order], -length[order]
        state = np.tile(self.begin, (len(order), 1))
        one, carry = np.uint64(1), np.uint64(63)
        for step in range(int(length.max(initial=0))):
            active = int(np.searchsorted(descending, -step, "left"))  # strings longer than step
            byte = self.kind[buf[start[:active] + step]]
            now = state[:active]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> carry
            state[:active] = (moved & self.enter[byte]) | (now & self.stay[byte])
        hit = np.empty((len(order), len(self.last)), dtype=bool)
        hit[order] = (state[:, self.last // 64] >> (self.last % 64).astype(np.uint64) & one).astype(bool)
        return hit


def escaped(text: str) -> str:
    """A glob that matches the text itself."""
    return re.sub(r"([*?\\])", r"\\\1", text)


def _stated(table, columns: list[str]) -> list:
    """The rows of a table of bounded size, as tuples (or values of one column); lists as they are."""
    if not isinstance(table, DataFrame):
        return list(table)
    rows = [tuple(r) for r in table.select(*columns).dropna().distinct().orderBy(*columns[::-1]).limit(MAX_GLOBS + 1).collect()]
    if len(rows) > MAX_GLOBS:
        raise ValueError(f"more than {MAX_GLOBS} rules or globs")
    return rows if len(columns) > 1 else [r[0] for r in rows]


def filter_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: list[tuple[str, str, str]] | DataFrame = RULES, block_globs: list[str] | DataFrame = BLOCK_GLOBS) -> DataFrame:
    """(page_id, host, path, rule, verdict, block_globs) of every page row; ``block_globs``
    are the globs that match it.

    ``rules`` are (action, host, path), or a table with these columns; ``block_globs`` are globs, or
    a table with a column glob.
    """
    rules, block_globs = _stated(rules, ["action", "host", "path"]), _stated(block_globs, ["glob"])
    rest = r"://([^/?#]*)([^?#]*)"
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    host = F.translate(F.regexp_extract(url, rest, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    d = pages.select(F.col(id_col).cast("bigint").alias("page_id"), host.alias("host"), F.regexp_extract(url, rest, 2).alias("path"))
    d = d.withColumn("canonical", F.concat("host", "path"))
    ranked = sorted(rules, key=lambda r: -len((r[1] + r[2]).encode()))  # stable: of equal length, the first stated
    literal = [r[1] + r[2] for r in ranked]
    shared = pages.sparkSession.sparkContext.broadcast(Automaton([g for x in map(escaped, literal) for g in (f"{x}**", f"*.{x}**")] + block_globs))
    names = pa.array([*literal, None], pa.string())
    actions = pa.array([*(r[0] for r in ranked), "allow", "block"], pa.string())
    globs = np.array([*block_globs, ""], dtype=object)
    n_rules = len(ranked)

    def judge(batches):
        automaton = shared.value
        together = max(1, STATE_BYTES // (24 * len(automaton.begin) + len(automaton.last)))
        for batch in batches:
            for at in range(0, batch.num_rows, together):
                part = batch.slice(at, together)
                for lo, hi, buf, offs in K.chunks(part.column(3)):
                    hit = automaton.run(buf, offs)
                    fits = hit[:, 0 : 2 * n_rules : 2] | hit[:, 1 : 2 * n_rules : 2]
                    rule = np.where(fits.any(axis=1), fits.argmax(axis=1), n_rules) if n_rules else np.zeros(hi - lo, np.int64)
                    blocked = hit[:, 2 * n_rules :]
                    verdict = np.where(rule < n_rules, rule, n_rules + blocked.any(axis=1))
                    row, which = np.nonzero(blocked)
                    yield pa.RecordBatch.from_arrays([*(c.slice(lo, hi - lo) for c in part.columns[:3]), names.take(pa.array(rule)), actions.take(pa.array(verdict)), K.list_array(globs[which], np.bincount(row, minlength=hi - lo), pa.string())], ["page_id", "host", "path", "rule", "verdict", "block_globs"])

    return d.mapInArrow(K.tidied(judge), "page_id bigint, host string, path string, rule string, verdict string, block_globs array<string>")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all of ``pages``."""
    return filter_urls(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict")


SQL = r"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
r AS (SELECT * FROM (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')) AS x(action, rule_host, rule_path)),
m AS (SELECT page_id, host, path, arg_max(action, length(rule_host || rule_path)) AS action, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule
      FROM u LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(action, CASE WHEN regexp_full_match(host || path, '[^/]*(BLOCK_WORDS)[^/]*(/.*)?') THEN 'block' ELSE 'allow' END) AS verdict FROM m
""".replace("BLOCK_WORDS", "|".join(BLOCK_WORDS))
