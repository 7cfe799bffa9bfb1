"""Secret scans: fixed patterns, and strings that a primed compressor cannot shorten.

Base patterns find assignments, access keys and hex runs. The method adds what they miss: a string of
key-like characters shortly after a word that announces a secret (sensitive context). It is measured by
its marginal cost: zstandard, primed with a dictionary of identifiers and the text around the
string, compresses the context alone and the context with the candidate. A name or a word repeats what the
dictionaries hold and costs few bytes; a random string costs nearly all its own. Candidates whose
marginal bytes per character reach ``NOVELTY`` are reported as kind ``novel``, unless they
overlap a base span. Other candidates that share ``SHARED`` characters with one are left out of the text
around it, so a secret that is announced twice doesn't make itself known. A string that also stands
where nothing announces it is a name.

Null text is empty. Every row is judged on its whole text, by itself; other columns are not read, so they may have any
names, and repeated rows give repeated results. An empty table gives none. The time grows with the length of a text, long
runs of announcing words included: a word inside a token announces what is left of it up to the next such word.
Spans are in code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docfold.llm.common import map_batches

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # runs are greedy, so a run of 16 or more is found whole

#: Words that announce a secret, and how far behind one a candidate may start.
CONTEXT_WORDS = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "api-key",
                 "access_key", "private_key", "credential", "bearer", "authorization",
                 "client_secret", "signature")
CONTEXT_REACH = 48
#: Characters before and behind the candidate that prime the compressor.
AROUND = 256
LEAST, NOVELTY = 16, 0.62
#: A candidate with this many characters of another one holds a long part of it.
SHARED = 8
_SENSITIVE = re.compile("|".join(map(re.escape, CONTEXT_WORDS)), re.IGNORECASE | re.ASCII)
#: Key-like runs joined by single dots; a candidate is one with a run that is long enough.
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]+(?:\.[A-Za-z0-9+/_=-]+)*")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST)

#: Names that are common in source code and configuration.
IDENTIFIERS = """
abstract access accessToken account action address admin allow amount annotation api api_key
application args argument array assert async attribute auth authenticate author authorization await
background base64 basic bearer before begin binary body boolean bool break browser buffer build button
cache callback cancel case catch certificate channel char check child class className click client client_id
client_secret close cloud code collection color column command comment commit common component config
configuration connect connection console const constructor container content context continue control
controller cookie copy count create created credential credentials current cursor customer data database
date datetime debug decode default define delete dependency deploy description destination development
device dict directory disable display document domain double download driver dynamic element email empty enable
encode encrypt endpoint entity enum environment error event example except exception execute expect
expires export extends external factory false feature fetch field file filename filter final finally find float
folder footer format forward frame function generate getElementById global group handle handler hash header
height hidden history host hostname http https identifier image implements import include index init input
insert instance integer interface internal interval invalid invoke issue item iterator javascript join json
key kind label language last layer layout length level library license limit line link list listener load local
localhost location lock log logger logging login logout long main manager map mapping master match max maximum
memory message metadata method middleware min minimum mode model module month mount move name namespace native
network node notification null number object offset open operation operator option options order organization
origin output override owner package page parameter params parent parse parser partition password path pattern
payload permission phone pipeline placeholder platform plugin pointer policy port position post prefix previous
primary print private private_key process processor product production profile project promise property protected
protocol provider proxy public publish pull push python query queue random range read receive record redirect
reference refresh region register release remote remove render repository request require required reset resource
response rest result retry return revision role root route router rule runtime sample save schedule schema scope
script search secret section secure security select self send sequence serialize server service session setting
settings setup share shell signature size sleep socket sort source space split start state static status step
storage store stream string struct style submit subscribe subscription success suffix super switch sync system
table target task template temporary tenant test text theme thread throw throws time timeout timestamp title token
tools top total trace transaction transform transport true try type undefined unique unit update upload url user
username user_id utils uuid valid validate value variable vector vendor verify version view virtual visible void
volume warning webhook while width window worker workspace write your-api-key-here changeme placeholder
xxxxxxxxxxxxxxxx 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ
""".split()

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
        ]
    )
)


def base_spans(text: str, lower: str | None = None) -> list[tuple[str, int, int]]:
    """``lower``: the text in lower case; few texts have one of the words at all."""
    lower = text.lower() if lower is None else lower
    found = []
    if any(word in lower for word in _ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


class Novelty:
    """Marginal compressed bytes of strings, with a compressor primed by a dictionary."""

    def __init__(self, identifiers: list[str] = IDENTIFIERS):
        words = " ".join(identifiers).encode()
        raw = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.packer = zstandard.ZstdCompressor(level=9, dict_data=raw, write_content_size=False)

    def per_char(
        self, text: str, start: int, end: int, others: list[tuple[int, int]] = ()
    ) -> float:
        """``others``: other candidates; those that hold a long part of this one are cut from the context."""
        low, high, cut = max(0, start - AROUND), end + AROUND, []
        near = [(max(a, low), min(b, high)) for a, b in others if a < high and b > low]
        near = [(a, b) for a, b in near if b <= start or a >= end]
        if near:
            own = _parts(text[start:end])
            cut = [(a, b) for a, b in near if not own.isdisjoint(_parts(text[a:b]))]
        context = _without(text, low, start, cut) + " " + _without(text, end, high, cut) + " "
        size = lambda x: len(self.packer.compress(x.encode("utf-8", "surrogatepass")))
        return (size(context + text[start:end]) - size(context)) / (end - start)

    def spans(
        self, text: str, lower: str, base: list[tuple[str, int, int]]
    ) -> list[tuple[str, int, int]]:
        """Candidates in sensitive context that are incompressible and overlap no base span."""
        if not any(word in lower for word in CONTEXT_WORDS):
            return []
        tokens = _announced(text)
        # A token with dots is judged whole, and by its runs if that finds nothing.
        announced = [[whole, *(r for r in runs if r != whole)] for whole, runs in tokens]
        starts = [whole[0] for whole, _ in tokens]
        base_starts, reached = [s for _, s, _ in base], list(accumulate((e for *_, e in base), max))
        found, longest = [], -1
        for i, spans in enumerate(announced):
            # Tokens are in order. What reaches into the context from before it is the last one, or the one that
            # has gone furthest.
            first = max(0, bisect_left(starts, spans[0][0] - AROUND) - 1)
            last = bisect_left(starts, spans[0][1] + AROUND)
            near = ([announced[longest]] if 0 <= longest < first else []) + announced[first:last]
            others = [s for x in near for s in x]
            if longest < 0 or spans[0][1] > announced[longest][0][1]:
                longest = i
            for start, end in spans:
                before = bisect_left(base_starts, end)
                if before and reached[before - 1] > start:
                    continue
                if self.per_char(text, start, end, others) >= NOVELTY:
                    found.append(("novel", start, end))
                    if (start, end) == spans[0]:
                        break
        return found


def _announced(text: str) -> list[tuple[tuple[int, int], list[tuple[int, int]]]]:
    """Tokens that start in reach of an announcing word, and their runs that are long enough, in order.

    A token in reach is taken whole, however long it is. A word inside a token announces the rest of it up to the
    next such word, so what is matched and judged grows with the text, however many words a token holds.
    """
    words = [w.span() for w in _SENSITIVE.finditer(text)]
    tokens, seen, known = [], -1, -1

    def take(start: int, end: int) -> None:
        nonlocal seen
        runs = [r.span() for r in _RUN.finditer(text, start, end)] if start > seen else []
        if runs:
            seen = start
            tokens.append(((start, end), runs))

    for i, (_, at) in enumerate(words):
        cut = words[i + 1][0] if i + 1 < len(words) else len(text)
        go_on = at
        if at < known:  # inside a token whose end is known
            if m := _TOKEN.search(text, at, min(cut, known)):
                take(*m.span())
            go_on = known
        for m in _TOKEN.finditer(text, go_on) if go_on <= at + CONTEXT_REACH else ():
            start, end = m.span()
            if start > at + CONTEXT_REACH:
                break
            known = max(known, end)
            own = start == at or text[at : at + 1] == "." and start == at + 1
            if own and start <= cut < end:
                if m := _TOKEN.search(text, start, cut):
                    take(*m.span())
            else:
                take(start, end)
    return tokens


def _parts(text: str) -> set[str]:
    return {text[i : i + SHARED] for i in range(len(text) - SHARED + 1)}


def _without(text: str, start: int, end: int, cut: list[tuple[int, int]]) -> str:
    """The text from start to end without the ranges in ``cut``, which are in order."""
    out = []
    for a, b in cut:
        if start < b and a < end:
            out.append(text[start : max(a, start)])
            start = b
    return "".join(out) + text[start:end]


def find(text: str | None, novelty: Novelty) -> list[tuple[str, int, int]]:
    """All spans of a text, by start and then kind."""
    text = text or ""
    lower = text.lower()
    base = base_spans(text, lower)
    added = novelty.spans(text, lower, base)
    return sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_assign, n_access, n_hex, base_sha256, spans (text), found (kind, start, end)."""
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
            T.StructField("base_sha256", T.StringType()),
            T.StructField("spans", T.StringType()),
            T.StructField("found", SPANS),
        ]
    )

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        novelty = Novelty()
        for batch in batches:
            found = [find(t, novelty) for t in batch.column("text").to_pylist()]
            base = [joined([s for s in spans if s[0] != "novel"]) for spans in found]
            yield {
                "doc_id": batch.column("doc_id"),
                **{f"n_{k}": [sum(s[0] == k for s in spans) for spans in found] for k in KINDS},
                "base_sha256": [hashlib.sha256(b.encode()).hexdigest() for b in base],
                "spans": list(map(joined, found)),
                "found": found,
            }

    return map_batches(docs.select("doc_id", "text"), step, schema)


def masked(text: str | None, spans: list[tuple[str, int, int]], mask: str = "*") -> str | None:
    """The text with every character of the spans replaced, so that its length stays."""
    if not spans:
        return text
    out, at = [], 0
    for _, start, end in spans:
        out.append(text[at:start])
        out.append(mask * (end - max(start, at)))
        at = max(at, end)
    return "".join(out) + text[at:]


def mask_secrets(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with all columns; the characters of secrets are masked in ``text``."""
    schema = docs.schema

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        novelty = Novelty()
        for batch in batches:
            texts = batch.column("text").to_pylist()
            columns = {f.name: batch.column(f.name) for f in schema}
            yield columns | {"text": [masked(t, find(t, novelty)) for t in texts]}

    return map_batches(docs, step, schema)
