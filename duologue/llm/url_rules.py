"""URL filters: all wildcard rules at once, as bits of one automaton.

Every glob becomes a row of states, one bit each: a start state, then one state per
character.  A wildcard lets the state before it stay.  The states of all globs lie one
after another in 64-bit words, so one shift, two table look-ups and an OR step all
rules over the next byte of many URLs (Shift-And over several words).

Globs: ``?`` one byte but ``/``; ``*`` any run without ``/``; ``**`` any run.  They match
the whole canonical URL, which is the lower-cased host followed by the path.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duologue.llm import workers

#: (verdict, host and path): a rule fits its host and all subdomains, if the path starts with the rule's.
SITE_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]

#: Pages that seldom hold prose on any host, and hosts named for what they sell.
BLOCK_GLOBS = [
    "**.exe",
    "**.zip",
    "**.apk",
    "**.iso",
    "**/cgi-bin/**",
    "**/wp-admin/**",
    "**/wp-login.php",
    "**/login/**",
    "**/cart/**",
    "**/checkout/**",
    "ads.*/**",
    "*.ads.*/**",
    "ads-*/**",
    "*.ads-*/**",
    "*adult-*/**",
    "*casino-*/**",
    "*-bets.*/**",
    "*-pills.*/**",
    "*spam-*/**",
    "*.onion/**",
]

ANY, NO_SLASH = 2, 1


class GlobSet:
    """Globs packed into bit masks; ``matches`` runs all of them over many byte strings."""

    def __init__(self, globs: list[str]) -> None:
        states: list[tuple[bytes | None, int]] = []  # (byte that leads here, or None at a start; stay kind)
        self.starts, self.finals = [], []
        for glob in globs:
            self.starts.append(len(states))
            states.append((None, 0))
            text = glob.encode()
            i = 0
            while i < len(text):
                if text[i : i + 1] == b"*":
                    run = len(text[i:]) - len(text[i:].lstrip(b"*"))
                    kind = ANY if run > 1 else NO_SLASH
                    states[-1] = (states[-1][0], max(states[-1][1], kind))
                    i += run
                else:
                    states.append((text[i : i + 1], 0))
                    i += 1
            self.finals.append(len(states) - 1)
        self.words = max(1, -(-len(states) // 64))
        self.step = np.zeros((256, self.words), np.uint64)
        self.stay = np.zeros((256, self.words), np.uint64)
        self.first = np.zeros(self.words, np.uint64)
        for s in self.starts:
            self.first[s // 64] |= np.uint64(1 << s % 64)
        for s, (byte, kind) in enumerate(states):
            bit = np.uint64(1 << s % 64)
            if byte == b"?":
                self.step[:, s // 64] |= bit
                self.step[ord("/"), s // 64] &= ~bit
            elif byte is not None:
                self.step[byte[0], s // 64] |= bit
            if kind:
                self.stay[:, s // 64] |= bit
            if kind == NO_SLASH:
                self.stay[ord("/"), s // 64] &= ~bit
        settled = np.zeros(self.words, np.uint64)  # accepting states that nothing leaves
        for s in self.finals:
            if states[s][1] == ANY:
                settled[s // 64] |= np.uint64(1 << s % 64)
        self.open = ~settled

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """Boolean matrix: text by glob."""
        found = np.tile(self.first, (len(texts), 1))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        order = np.argsort(-lengths, kind="stable")
        joined = np.frombuffer(b"".join(texts), np.uint8)
        begins = (np.cumsum(lengths) - lengths)[order]
        ends = lengths[order]
        state = found[order]
        alive = np.arange(len(texts))
        t = 0
        while True:
            live = int(np.searchsorted(-ends[alive], -t, side="left"))  # texts longer than t come first
            alive = alive[:live]
            if not live:
                break
            if t % 32 == 31:  # the rest can't change any more
                alive = alive[((state[alive] & self.open) != 0).any(axis=1)]
                if not len(alive):
                    break
            now = state[alive]
            byte = joined[begins[alive] + t]
            moved = now << np.uint64(1)
            moved[:, 1:] |= now[:, :-1] >> np.uint64(63)
            state[alive] = (moved & self.step[byte]) | (now & self.stay[byte])
            t += 1
        found[order] = state
        hit = np.empty((len(texts), len(self.finals)), bool)
        for k, s in enumerate(self.finals):
            hit[:, k] = (found[:, s // 64] >> np.uint64(s % 64)) & np.uint64(1)
        return hit


@dataclass
class UrlFilter:
    """Site rules (longest wins, then the first) before block globs; other URLs with a host pass."""

    rules: list[tuple[str, str]]
    globs: list[str]

    def __post_init__(self) -> None:
        ranked = sorted(range(len(self.rules)), key=lambda i: (-len(self.rules[i][1]), i))
        self.ranked = [self.rules[i] for i in ranked]
        site = [g for _, rule in self.ranked for g in (f"{rule}**", f"*.{rule}**")]
        self.automaton = GlobSet(site + self.globs)

    def judge(self, urls: list[bytes], has_host: np.ndarray) -> tuple[list, list, list]:
        """Rule, verdict and glob of each canonical URL."""
        hit = self.automaton.matches(urls)
        n = len(self.ranked)
        by_rule = hit[:, 0 : 2 * n : 2] | hit[:, 1 : 2 * n : 2]
        rule = np.where(by_rule.any(axis=1), by_rule.argmax(axis=1), n) if n else np.full(len(urls), 0)
        by_glob = hit[:, 2 * n :]
        glob = np.where(by_glob.any(axis=1), by_glob.argmax(axis=1), -1) if self.globs else np.full(len(urls), -1)
        rules = [r for _, r in self.ranked] + [None]
        verdicts = [v for v, _ in self.ranked]
        out = [
            verdicts[r] if r < n else "allow" if h and g < 0 else "block"
            for r, g, h in zip(rule.tolist(), glob.tolist(), has_host.tolist(), strict=True)
        ]
        return [rules[r] for r in rule.tolist()], out, [self.globs[g] if g >= 0 else None for g in glob.tolist()]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str]] = SITE_RULES,
    globs: list[str] = BLOCK_GLOBS,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per input row: key, host, path, rule, verdict, and the glob that matched.

    A null URL or one without ``://`` has an empty host and path, no rule, and is blocked;
    so is an empty host.  Rows with equal keys or URLs are judged each for itself; a null
    key stays null.  Other columns are not read.  No shuffle; memory is one Arrow batch.
    """
    host, path = host_and_path(pages[url])
    parts = pages.select(pages[key].alias("key"), host.alias("host"), path.alias("path"))
    kind = dict(parts.dtypes)["key"]
    urls = UrlFilter(list(rules), list(globs))

    def judge(batch: pa.RecordBatch) -> pa.RecordBatch:
        hosts, paths = workers.utf8(batch["host"]), workers.utf8(batch["path"])
        has_host = np.fromiter(map(bool, hosts), bool, len(hosts))
        rule, verdict, glob = urls.judge([h + p for h, p in zip(hosts, paths, strict=True)], has_host)
        columns = [batch["key"], batch["host"], batch["path"], *(pa.array(x, pa.string()) for x in (rule, verdict, glob))]
        return pa.RecordBatch.from_arrays(columns, ["key", "host", "path", "rule", "verdict", "glob"])

    return workers.map_batches(parts, judge, f"key {kind}, host string, path string, rule string, verdict string, glob string")
