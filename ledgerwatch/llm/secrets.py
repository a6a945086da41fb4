"""Secrets in texts, judged by who else in the corpus has the same value."""

from __future__ import annotations

import re
from bisect import bisect_right
from math import log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.text import columns_of, map_batches
from ledgerwatch.session import stored

#: The base patterns with the least length of what they hold (group 2 or all), in their order.
BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"[0-9a-f]{32,}"), 0, 32),
}
#: Further candidates; they count only where the corpus shows them to be owner-specific.
MORE = {
    "bearer": (re.compile(r"\b[Bb]earer\x20+([A-Za-z0-9+/_.=-]+)", re.A), 1, 20),
    "issued": (re.compile(r"\b(?:gh[pousr]_|sk[-_](?:live_|proj-)?|xox[abp]-|AIza|glpat-)([A-Za-z0-9_-]+)", re.A), 0, 20),
    "jwt": (re.compile(r"\beyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", re.A), 0, 30),
    "url": (re.compile(r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]{1,64}:([^\s/:@]+)@", re.A), 1, 6),
    "random": (re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}={0,2}(?![A-Za-z0-9+/_=-])", re.A), 0, 24),
}
#: What a text must hold for a pattern to be worth trying.
_NEEDED = {"bearer": "earer\x20", "jwt": "eyJ", "url": "://"}
KINDS = (*BASE, *MORE)
#: A value found with more owners, and in more repositories, than these is a copied example.
MAX_OWNERS = 5
MAX_REPOSITORIES = 5


def looks_random(value: str) -> bool:
    """Letters of both cases and digits, spread like a key rather than like a word or a path."""
    kinds = sum(any(f(c) for c in value) for f in (str.isupper, str.islower, str.isdigit))
    if kinds < 3:
        return False
    counts = [value.count(c) for c in set(value)]
    return -sum(n / len(value) * log2(n / len(value)) for n in counts) >= 3.5


def candidates_in(text: str | None) -> list[tuple[int, str, int, str]]:
    """(start, kind, end, value) of the base patterns and of further ones that overlap none of the base, by start, then kind in order."""
    if not text:
        return []
    found = []
    for kind, (pattern, group, least) in BASE.items():
        found += [(m.start(), kind, m.end(), m.group(group)) for m in pattern.finditer(text) if len(m.group(group)) >= least]
    # disjoint spans in order, so that one look to either side tells whether a place is free
    starts: list[int] = []
    ends: list[int] = []
    for a, _, b, _ in sorted(found):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for kind, (pattern, group, least) in MORE.items():
        if kind in _NEEDED and _NEEDED[kind] not in text:
            continue
        for m in pattern.finditer(text):
            value = m.group(group)
            at = bisect_right(starts, m.start())
            free = (at == 0 or ends[at - 1] <= m.start()) and (at == len(starts) or m.end() <= starts[at])
            if free and len(value) >= least and (kind in ("issued", "jwt", "url") or looks_random(value)):
                found.append((m.start(), kind, m.end(), value))
                starts.insert(at, m.start())
                ends.insert(at, m.end())
    return sorted(found, key=lambda f: (f[0], KINDS.index(f[1]), f[2]))


def find_candidates(docs: DataFrame, carry: list[Column], text_col: str = "text") -> DataFrame:
    """The columns ``carry`` and ``found``: start, kind, end, digest of the value (SHA-256) and whether it is a base span."""
    rows = docs.select(F.struct(*carry).alias("d"), F.col(text_col).alias("t"))
    kind = rows.schema["d"].dataType.simpleString()

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        from hashlib import sha256

        found = [[{"start": a, "kind": k, "end": b, "digest": sha256(v.encode("utf-8", "replace")).hexdigest(), "base": k in BASE} for a, k, b, v in candidates_in(t)] for t in columns_of(batch, "t")[0]]
        return pa.RecordBatch.from_arrays([batch.column("d"), pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64()), ("digest", pa.string()), ("base", pa.bool_())])))], ["d", "found"])

    return map_batches(rows, convert, f"d {kind}, found array<struct<start: bigint, kind: string, end: bigint, digest: string, base: boolean>>")


def ownership(found: DataFrame) -> DataFrame:
    """``digest``, ``owners``, ``repositories`` and ``live`` from columns ``found``, ``owner`` and ``repository``.

    Counted over the whole corpus; each owner and repository of a value is one row before it is shuffled on, so a value
    that a third of the corpus holds is no heavier than another. A missing owner or repository counts as one of its own.
    """
    each = found.select(F.explode("found.digest").alias("digest"), F.coalesce("owner", F.lit("")).alias("owner"), F.coalesce("repository", F.lit("")).alias("repository")).distinct()
    # distinct owners and distinct repositories in two plain steps
    owners = each.groupBy("digest", "owner").agg(F.count("*").alias("n")).groupBy("digest").agg(F.count("*").alias("owners"))
    repositories = each.select("digest", "repository").distinct().groupBy("digest").agg(F.count("*").alias("repositories"))
    both = owners.join(repositories, "digest")
    return both.withColumn("live", ~((F.col("owners") > MAX_OWNERS) & (F.col("repositories") > MAX_REPOSITORIES)))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner: Column | str = "source", repository: Column | str | None = None) -> DataFrame:
    """``id_col`` and ``found`` for every row: start, kind, end, base, live, owners and repositories of each span, by start, then kind.

    Base spans (``BASE``) always stay; further candidates (``MORE``) stay if the corpus shows them to be owner-specific
    (``live``). ``owner`` and ``repository`` are columns or expressions; without ``repository`` it is the owner. Null and
    empty texts have no spans; repeated rows and null ids give a row each; an empty table gives an empty result.
    """
    owner = F.col(owner) if isinstance(owner, str) else owner
    repository = owner if repository is None else F.col(repository) if isinstance(repository, str) else repository
    rows = find_candidates(docs, [F.col(id_col).alias("id"), owner.cast("string").alias("owner"), repository.cast("string").alias("repository")], text_col)
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "candidates")
    owned = ownership(rows.select("found", "d.owner", "d.repository"))
    spans = rows.select("row", F.posexplode("found").alias("at", "x")).select("row", "at", "x.*").join(owned, "digest").where("base OR live")
    lists = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("at", "start", "kind", "end", "base", "live", "owners", "repositories"))).alias("spans"))
    kind = lists.schema["spans"].dataType.simpleString()
    return rows.join(lists, "row", "left").select(F.col("d.id").alias(id_col), F.coalesce("spans", F.expr(f"CAST(array() AS {kind})")).alias("found"))


def redact(docs: DataFrame, text_col: str = "text", owner: Column | str = "source", repository: Column | str | None = None, mark: str = "<secret>") -> DataFrame:
    """``docs`` with every owner-specific span (base or further) replaced by ``mark``; copied examples and all else stay.

    Texts without candidates are passed on where they are read. The others are written to the shared folder with a
    row number, and their values are joined with the examples, not their texts. Null and empty texts stay as they
    are; ids are not looked at; repeated rows are cut each; an empty table stays empty.
    """
    owner = F.col(owner) if isinstance(owner, str) else owner
    repository = owner if repository is None else F.col(repository) if isinstance(repository, str) else repository
    columns = docs.columns
    whole = find_candidates(docs, [F.struct(*(F.col(f"`{c}`") for c in columns)).alias("r"), F.col(text_col).alias("t"), owner.cast("string").alias("owner"), repository.cast("string").alias("repository")], text_col)
    clean = whole.where("size(found) = 0").select("d.r.*")
    hit = stored(whole.where("size(found) > 0").withColumn("row", F.monotonically_increasing_id()), "candidates")
    copied = ownership(hit.select("found", "d.owner", "d.repository")).where("NOT live").select("digest")
    spans = hit.select("row", F.inline("found")).join(copied, "digest", "left_anti")
    cuts = spans.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("cuts"))
    # spans may overlap: each is cut from where the one before has ended
    rest = F.expr(
        "aggregate(cuts, struct(CAST('' AS STRING) AS s, 0L AS at),"
        " (a, c) -> IF(c.end <= a.at, a, struct(concat(a.s, IF(c.start >= a.at, concat(substring(d.t, CAST(a.at + 1 AS INT), CAST(c.start - a.at AS INT)), mark), '')) AS s, c.end AS at)),"
        " a -> concat(a.s, substring(d.t, CAST(a.at + 1 AS INT))))"
    )
    cut = hit.join(cuts, "row", "left").withColumn("mark", F.lit(mark)).withColumn("new", F.when(F.col("cuts").isNull(), F.col("d.t")).otherwise(rest))
    return clean.unionByName(cut.select(*((F.col("new") if c == text_col else F.col("d.r")[c]).alias(c) for c in columns)))
