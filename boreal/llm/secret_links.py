"""Secrets in texts: certain finds, and weak ones that stand together.

Method: multipart credential linking. Each text is searched for certain finds (assigned secrets, access
identifiers, hex keys) and for weak candidates: identifiers (a user, login or client id), secrets (a short assigned
value, or a run of 20 or more mixed letters and digits) and endpoints (a URL or an address), which alone are mostly harmless. All are
intervals in their text. An interval join within scopes (paragraphs: text between blank lines) then asks which parts lie
within ``reach`` characters of one another: a weak identifier is reported beside a secret, a weak secret beside an
identifier, an endpoint beside both. Certain finds serve as partners and always stay.

Scale: searching is a map over rows; every pattern reads a text once. Only intervals of texts with both an
identifier and a secret go on. They are joined per (text, scope, tile of 65,536 characters) in order of position by
running maxima and minima, so no pairs are built, and one very long text with a third of all parts is many groups; a part
that reaches over the border of a tile is in both. Texts are never shuffled.

Edge cases: null and empty texts have no finds; a text of any length is searched whole; overlapping finds of different
kinds all stay, while a weak candidate inside a certain find is none; repeated rows and rows without an id are separate
texts; an empty table gives an empty result; other columns are not read. Letters match in either case only within ASCII.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boreal.llm.storage import written
from boreal.llm.worker import claim

#: All kinds in the order in which finds of one place are listed.
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
ASSIGN, ACCESS, HEX, IDENTIFIER, SECRET, ENDPOINT = range(6)
#: Patterns of certain finds (fixed values) and of weak candidates.
VALUE = r"""["']?\x20*[:=]\x20*["']?"""
PATTERNS = {
    ASSIGN: r"(password|passwd|secret|token|api_?key)" + VALUE + r"([A-Za-z0-9+/_.=-]+)",
    ACCESS: r"AKIA[A-Z0-9]+",
    HEX: r"[0-9a-f]+",
    IDENTIFIER: r"(user|username|login|account|client_?id|access_?key_?id)" + VALUE + r"([A-Za-z0-9@._+-]+)",
    SECRET: r"[A-Za-z0-9+/_=-]+",
    ENDPOINT: r"""\b[a-z]+://[^\x20\x09-\x0D"'<>]+|\b[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+\b""",
}
BLANK = r"\n(?:[\x20\x09\x0D]*\n)+"
EITHER_CASE = (ASSIGN, IDENTIFIER)
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX, LEAST_WEAK, LEAST_NAME, LEAST_RUN = 12, 18, 16, 4, 3, 20
MIXED = ("[a-z]", "[A-Z]", "[0-9]")
TILE = 1 << 16

_FIND = {k: re.compile(p, re.ASCII | (re.IGNORECASE if k in EITHER_CASE else 0)) for k, p in PATTERNS.items()}
_BLANK, _MIXED = re.compile(BLANK), [re.compile(p) for p in MIXED]

SPAN = "struct<start:long,kind:int,end:long>"
PART = "struct<start:long,kind:int,end:long,scope:long>"


def _apart(spans: list[tuple], taken: list[tuple]) -> list[tuple]:
    """The spans that overlap none of ``taken`` (any order; spans are (start, kind, end))."""
    merged: list[list[int]] = []
    for start, _, end in sorted(taken):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    ends = [m[1] for m in merged]
    out = []
    for span in spans:
        at = bisect_left(ends, span[0] + 1)  # the first that ends behind the span's start
        if at == len(merged) or merged[at][0] >= span[2]:
            out.append(span)
    return out


def find_parts(text: str) -> tuple[list[tuple], list[tuple]]:
    """(start, kind, end) of the certain finds, and of the weak candidates that may have a partner in the text."""
    assigned = [(m.start(), m.end(), len(m[2])) for m in _FIND[ASSIGN].finditer(text)]
    base = [(a, ASSIGN, b) for a, b, n in assigned if n >= LEAST_VALUE]
    short = [(a, SECRET, b) for a, b, n in assigned if LEAST_WEAK <= n < LEAST_VALUE]
    for kind, least in ((ACCESS, LEAST_ACCESS), (HEX, LEAST_HEX)):
        base += [(m.start(), kind, m.end()) for m in _FIND[kind].finditer(text) if m.end() - m.start() >= least]
    base.sort()
    names = _apart([(m.start(), IDENTIFIER, m.end()) for m in _FIND[IDENTIFIER].finditer(text)
                    if len(m[2]) >= LEAST_NAME], base)
    if not names and not any(k == ACCESS for _, k, _ in base):
        return base, []
    places = [(m.start(), ENDPOINT, m.end()) for m in _FIND[ENDPOINT].finditer(text)]
    runs = [(m.start(), SECRET, m.end()) for m in _FIND[SECRET].finditer(text)
            if m.end() - m.start() >= LEAST_RUN and all(p.search(m[0]) for p in _MIXED)]
    secrets = _apart(short, base) + _apart(runs, base + short + names + places)
    if not secrets and not any(k == ASSIGN for _, k, _ in base):
        return base, []
    return base, sorted(names + secrets + places)


def search(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, base, parts): every text's certain finds, and all parts with their scope where some may link."""
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    part = pa.struct([*span, ("scope", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("secret_links")
        for batch in batches:
            found, parts = [], []
            for x in batch.column("text"):
                text = x.as_py() or ""
                base, weak = find_parts(text)
                found.append([dict(zip(("start", "kind", "end"), s)) for s in base])
                ends = [m.end() for m in _BLANK.finditer(text)] if weak else []
                parts.append([{"start": a, "kind": k, "end": b, "scope": bisect_left(ends, a + 1)}
                              for a, k, b in (sorted(base + weak) if weak else []) if k != HEX])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.list_(span)), pa.array(parts, pa.list_(part))],
                ["doc_id", "base", "parts"])

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {id_type}, base array<{SPAN}>, parts array<{PART}>")
    return found.select(F.monotonically_increasing_id().alias("row"), "*")


def linked(parts: DataFrame, reach: int, tile: int = TILE) -> DataFrame:
    """The weak ones of ``parts`` (row, scope, start, kind, end) that have their complement within ``reach`` characters
    in their scope."""
    # two parts are in reach exactly when their places, each lengthened by reach at the end, overlap: then they share a tile
    tiles = F.explode(F.sequence(F.floor(F.col("start") / tile), F.floor((F.col("end") + reach) / tile)))
    placed = parts.select("row", "scope", "start", "kind", "end", tiles.alias("tile"))
    order = Window.partitionBy("row", "scope", "tile").orderBy("start", "kind")
    before, behind = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)

    def near(*kinds: int) -> Column:
        is_part = F.col("kind").isin(*kinds)
        last = F.max(F.when(is_part, F.col("end"))).over(before)
        following = F.min(F.when(is_part, F.col("start"))).over(behind)
        return F.coalesce(F.col("start") - last <= reach, F.lit(False)) | F.coalesce(following - F.col("end") <= reach, F.lit(False))

    met = placed.select("row", F.struct("start", "kind", "end").alias("span"), near(ACCESS, IDENTIFIER).alias("by_identifier"),
                        near(ASSIGN, SECRET).alias("by_secret")).filter("by_identifier OR by_secret")
    met = met.groupBy("row", "span").agg(F.max("by_identifier").alias("by_identifier"), F.max("by_secret").alias("by_secret"))
    kind = F.col("span.kind")
    return met.filter(
        F.when(kind == IDENTIFIER, F.col("by_secret")).when(kind == SECRET, F.col("by_identifier"))
        .when(kind == ENDPOINT, F.col("by_identifier") & F.col("by_secret")).otherwise(False)).select("row", "span")


def as_text(spans: Column) -> Column:
    """Spans as kind:start:end by start, then kind, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


def credentials(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", reach: int = 200) -> DataFrame:
    """One row per document: doc_id, base (certain finds) and linked (reported weak ones), arrays of (start, kind, end)
    in order; kind counts from 0 in ``KINDS``, places are code points, the end is exclusive."""
    found = written(search(docs, doc_id, text), "secret-parts")
    parts = found.filter(F.size("parts") > 0).select("row", F.explode("parts").alias("part")).select("row", "part.*")
    links = linked(parts, reach).groupBy("row").agg(F.sort_array(F.collect_list("span")).alias("linked"))
    return found.join(links, "row", "left").select(
        "doc_id", "base", F.coalesce("linked", F.array().cast(f"array<{SPAN}>")).alias("linked"))
