"""Splice chains: one vectorised UDF hop from the search sequence to chain, tail and size class."""

from __future__ import annotations

from collections.abc import Callable, Generator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Assay, SpliceConfig
from ..functions import fuzzy, seq

#: Bases kept before an acceptor without D1, and after an unrecognised D1.
CONTEXT = 15
#: Edits allowed where no D1 was seen, whatever the run's distance.
ALTERNATIVE_DISTANCE = 1
MOST_SLICES = 10
#: Different pairs of a batch that are read together: bounds a worker's memory.
TOGETHER = 4096

EVENT = T.StructType([
    T.StructField("chain", T.ArrayType(T.StringType())),
    T.StructField("tail", T.StringType()),
    T.StructField("alternative_d1_used", T.StringType()),
    T.StructField("unknown_sequence_after_d1", T.StringType()),
    T.StructField("size_class", T.StringType()),
])


#: The searches of a sequence: (sequence, list of patterns, edits) asked for, (name, place) or None answered.
Flow = Generator[tuple[bytes, str, int], tuple[str, int] | None, tuple]


class Reader:
    """Reads the ordered events of sequences."""

    def __init__(self, config: SpliceConfig):
        self.c, self.k = config, config.distance
        self.site = {n: s.encode() for n, s in config.sites.items()}
        encoded = lambda steps: [(s.acceptor, s.pattern.encode()) for s in steps]
        self.after = {"D1": encoded(config.d1_to_all), "D1prime": encoded(config.d1prime_to_all), "none": encoded(config.alternative_d1_to_all), "D2": encoded(config.d2_to_all), "D2b": encoded(config.d2b_to_all), "D3": encoded(config.d3_to_all)}
        genome = fuzzy.Index(config.genome.encode())
        self.locate = lru_cache(1 << 14)(lambda piece: genome.find(piece, self.k))

        self.lists = {f"at {n}": [(n, p)] for n, p in self.site.items()} | self.after

    def first(self, s: bytes, donor: str, k: int) -> tuple[str, int] | None:
        """The first of a donor's acceptors, in their order, that occurs; and where it starts."""
        return self.first_many([s], donor, k)[0]

    def first_many(self, texts: list[bytes], wanted: str, k: int) -> list[tuple[str, int] | None]:
        """The same of many sequences: each pattern is looked for in those that none before it was found in."""
        out: list[tuple[str, int] | None] = [None] * len(texts)
        left = list(range(len(texts)))
        for name, pattern in self.lists[wanted]:
            found = fuzzy.find_many([texts[i] for i in left], pattern, k)
            for i, hit in zip(left, found):
                if hit:
                    out[i] = name, hit[0]
            left = [i for i, hit in zip(left, found) if not hit]
            if not left:
                break
        return out

    def read(self, s: bytes) -> tuple[list[str], bytes, bytes | None, bytes | None]:
        """Chain, tail from the last recognised site, and the two context sequences."""
        return self.read_many([s])[0]

    def read_many(self, texts: list[bytes]) -> list[tuple[list[str], bytes, bytes | None, bytes | None]]:
        """The same of many sequences, which go from search to search together: those that wait for one kind of search are served at once."""
        out: list = [None] * len(texts)
        flows = [self._flow(s) for s in texts]
        waiting: dict[tuple[str, int], list[tuple[int, bytes]]] = {}
        for i, flow in enumerate(flows):
            s, wanted, k = next(flow)
            waiting.setdefault((wanted, k), []).append((i, s))
        while waiting:
            wanted, k = key = max(waiting, key=lambda x: len(waiting[x]))
            rows = waiting.pop(key)
            for (i, _), hit in zip(rows, self.first_many([s for _, s in rows], wanted, k)):
                try:
                    s, then, j = flows[i].send(hit)
                    waiting.setdefault((then, j), []).append((i, s))
                except StopIteration as done:
                    out[i] = done.value
        return out

    def _flow(self, s: bytes) -> Flow:
        """The searches of one sequence, one after another: yields what is wanted in what sequence, and is sent what was found."""
        k = self.k
        if not (hit := (yield s, "at D1", k)):
            return (yield from self._without_d1(["noD1"], s, None))
        s, d1 = s[hit[1] :], len(self.site["D1"])
        if got := (yield s, "D1", k):
            return (*(yield from self._onward(["D1", got[0]], got[0], s[got[1] :])), None, None)
        beyond = s[d1 : d1 + CONTEXT] if s else None
        if not s:
            return ["D1", "unknown"], s, None, None
        if got := (yield s, "D1prime", k):
            return (*(yield from self._onward(["D1prime", got[0]], got[0], s[got[1] :])), None, beyond)
        if len(s) > d1 + 4:
            return (yield from self._without_d1(["D1", "unknown"], s, s[d1 + 4 : d1 + 4 + CONTEXT]))
        return ["D1", "unknown"], s, None, beyond

    def _without_d1(self, chain: list[str], s: bytes, beyond: bytes | None) -> Flow:
        if not (got := (yield s, "none", ALTERNATIVE_DISTANCE)):
            return chain + ["no-acceptor"], s, None, beyond
        name, at = got
        before, tail = s[max(0, at - CONTEXT) : at], s[at:]
        if name == "gag-AUG":
            return chain + [name, "unspliced"], tail, before, beyond
        return (*(yield from self._onward(chain + [name], name, tail)), before, beyond)

    def _onward(self, chain: list[str], last: str, s: bytes) -> Flow:
        """What follows an acceptor: D2 after A1, D3 after A2, nothing after the others."""
        k = self.k
        if last == "A1":
            if not (hit := (yield s, "at D2", k)):
                return chain + ["noD2"], s
            s, chain = s[hit[1] :], chain + ["D2"]
            if not (got := (yield s, "D2", k)):
                return chain + ["unknown"], s
            chain, s = chain + [got[0]], s[got[1] :]
            if got[0] == "D2-unspliced":
                if not (hit := (yield s, "at D2b", k)):
                    return chain + ["noD2b"], s
                s, chain = s[hit[1] :], chain + ["D2b"]
                if not (got := (yield s, "D2b", k)):
                    return chain + ["unknown"], s
                chain, s = chain + [got[0]], s[got[1] :]
            return (yield from self._onward(chain, got[0], s)) if got[0] == "A2" else (chain, s)
        if last == "A2":
            if not (hit := (yield s, "at D3", k)):
                return chain + ["noD3"], s
            s, chain = s[hit[1] :], chain + ["D3"]
            got = yield s, "D3", k
            return (chain + [got[0]], s[got[1] :]) if got else (chain + ["unknown"], s)
        return chain, s

    def size_class(self, chain: list[str], tail: bytes) -> str:
        for e in chain:
            if e == "A7":
                return "1.8kb"
            if e in ("unknown", "no-acceptor"):
                return "Unknown"
            if e in ("D1-unspliced", "gag-AUG"):
                return "Unspliced"
        low, high = self.c.d4_breakpoint, self.c.a7_breakpoint
        if self.c.assay is not Assay.RANDOM_REVERSE:
            if len(tail) < 30 or not (hit := self.locate(tail[-30:-15])):
                return "Unknown"
            if hit[0] > high:
                return "1.8kb"
            return "4kb" if self.c.assay is Assay.K_MER or hit[0] < low else "Unknown"
        after = before = False
        for piece in slices(tail)[:MOST_SLICES]:
            if hit := self.locate(piece):
                if low < hit[0] < high:
                    return "4kb"
                after |= hit[0] > high
                before |= hit[0] < low
        return "1.8kb" if after else "Both" if before else "Unknown"


def slices(s: bytes, size: int = 20, skip: int = 15, least: int = 10) -> list[bytes]:
    """The same pieces as ``seq.slices_from_end``."""
    out, end = [], len(s) - skip
    while end >= least:
        out.append(s[max(0, end - size) : end])
        end -= size
    return out


def splice_chain(config: SpliceConfig):
    """UDF: (forward sequence, reverse sequence) -> joined sequence and event."""
    result = T.StructType([T.StructField("joined", T.StringType()), *EVENT.fields])

    @F.pandas_udf(result)
    def run(forward: pd.Series, reverse: pd.Series) -> pd.DataFrame:
        reader = _reader(config)
        keys = list(zip(forward, reverse))
        different = list(dict.fromkeys(keys))  # copies of a pair are read once
        rows = {}
        for lo in range(0, len(different), TOGETHER):
            some = different[lo : lo + TOGETHER]
            rows.update(zip(some, _read_pairs(reader, some)))
        return pd.DataFrame([rows[k] for k in keys], columns=result.names)

    # a filter on what it finds must not run it a second time, nor before the rows are spread
    return run.asNondeterministic()


def _read_pairs(reader: Reader, pairs: list[tuple[str, str]]) -> Generator[tuple, None, None]:
    """Joined read, chain, tail, contexts and size class of (forward, reverse) sequences."""
    a = [x.encode() for x, _ in pairs]
    b = [fuzzy.revcomp(y.encode()) for _, y in pairs]
    joined = [fuzzy.join_pair(x, y, o) for x, y, o in zip(a, b, fuzzy.overlaps(a, b))]
    read = reader.read_many([x + y if j is None else j for x, y, j in zip(a, b, joined)])
    text = lambda t: None if t is None else t.decode()
    sizes: dict[tuple, str] = {}  # reads of one isoform share what follows their last site
    for j, (chain, tail, alternative, beyond) in zip(joined, read):
        key = *chain, tail
        if key not in sizes:
            sizes[key] = reader.size_class(chain, tail)
        yield text(j), chain, text(tail), text(alternative), text(beyond), sizes[key]


@lru_cache(4)
def _cached(strain: str, assay: Assay, distance: int, sites: tuple, genome: str, steps: tuple) -> Reader:
    return Reader(SpliceConfig(strain, assay, distance, dict(sites), genome, *steps))


def _reader(c: SpliceConfig) -> Reader:
    """One reader for each worker and configuration, so that located pieces are remembered between batches."""
    return _cached(c.strain, c.assay, c.distance, tuple(c.sites.items()), c.genome, (c.d1_to_all, c.d1prime_to_all, c.alternative_d1_to_all, c.d2_to_all, c.d2b_to_all, c.d3_to_all))


def find_udf(pattern: str, k: int):
    """UDF: where a pattern matches best: struct of start, end, distance, or NULL."""

    @F.pandas_udf("start int, stop int, distance int")
    def run(s: pd.Series) -> pd.DataFrame:
        p = pattern.encode()
        return pd.DataFrame([hit or (None, None, None) for hit in fuzzy.find_many([x.encode() for x in s], p, k)], columns=["start", "stop", "distance"]).astype("Int32")

    return run


def first_udf(config: SpliceConfig, donor: str, k: int | None = None):
    """UDF: the first of a donor's acceptors that occurs, where it starts, the sequence from there on and the bases before."""

    @F.pandas_udf("acceptor string, start int, tail string, donor string")
    def run(s: pd.Series) -> pd.DataFrame:
        reader = _reader(config)
        rows = []
        for x, hit in zip(s, reader.first_many([x.encode() for x in s], donor, reader.k if k is None else k)):
            rows.append((hit[0], hit[1], x[hit[1] :], x[max(0, hit[1] - CONTEXT) : hit[1]]) if hit else (None, None, None, None))
        return pd.DataFrame(rows, columns=["acceptor", "start", "tail", "donor"], dtype=object)

    return run


def size_class_udf(config: SpliceConfig):
    """UDF: size class of a chain and the sequence from its last site on."""

    @F.pandas_udf("string")
    def run(chain: pd.Series, tail: pd.Series) -> pd.Series:
        reader = _reader(config)
        return pd.Series([reader.size_class(list(c), t.encode()) for c, t in zip(chain, tail)], dtype=object)

    return run


def overlap_udf(least: int = 10, rate: float = 0.02):
    """UDF: overlap of a forward sequence with the reverse complement of a reverse sequence, or NULL."""

    @F.pandas_udf("int")
    def run(forward: pd.Series, reverse: pd.Series) -> pd.Series:
        return pd.Series(fuzzy.overlaps([x.encode() for x in forward], [fuzzy.revcomp(x.encode()) for x in reverse], least, rate), dtype="Int32")

    return run


def rejects(header: str | None, distance: int) -> dict[str, Column]:
    """Why a read pair (r1, r2) is left out: conditions by name, of which the first that holds counts."""
    why = {"too_short": ~seq.readable(F.col("r1"), F.col("r2")), "homopolymer": seq.has_homopolymer(F.col("r1")) | seq.has_homopolymer(F.col("r2"))}
    return why | ({"header": ~seq.header_matches(F.upper("r1"), header, distance)} if header else {})


def reject_counts(header: str | None, distance: int) -> list[Column]:
    """Aggregates: read pairs, and those left out for each reason."""
    out, before = [F.count(F.lit(1)).alias("pairs")], F.lit(False)
    for name, wrong in rejects(header, distance).items():
        out.append(F.count_if(F.coalesce(wrong, F.lit(True)) & ~before).alias(name))
        before = before | F.coalesce(wrong, F.lit(True))
    return out


def events(reads: DataFrame, config: SpliceConfig, header: str | None = None, hop: Callable[[str, str], Column] | None = None) -> DataFrame:
    """Per-read events of (read_ix, id, r1, r2).

    Native filters come first so that ``hop``, which joins the two reads and reads
    the chain (the UDF, if none is given), sees as few rows as possible:
    homopolymers on the raw reads, reads too short to split, the header pattern.
    """
    kept = reads
    for wrong in rejects(header, config.distance).values():
        kept = kept.where(~wrong)
    parts = kept.select("read_ix", F.col("id").alias("sequence_id"), *[c.alias(n) for n, c in seq.split_reads(F.col("r1"), F.col("r2")).items()])
    found = parts.withColumn("e", (hop or splice_chain(config))("forward_sequence", "reverse_sequence"))
    return found.select("read_ix", "sequence_id", "forward_ns", "umi", "forward_sequence", "reverse_sequence", F.col("e.joined").alias("joined_sequence"), F.col("e.chain").alias("chain"), F.array_join("e.chain", "_").alias("splice_category"), F.col("e.size_class").alias("size_class"), final_category(F.col("e.chain"), F.col("e.size_class")).alias("final_category"), "e.alternative_d1_used", "e.unknown_sequence_after_d1", F.col("e.tail").alias("post_splice_sequence"))


def final_category(chain: Column, size: Column) -> Column:
    return F.concat_ws("_", F.array_join(chain, "_"), F.coalesce(size, F.lit("Unknown")))


def add_event(chain: Column, event: str) -> Column:
    return F.array_append(chain, F.lit(event))


def remove_event(chain: Column, event: str) -> Column:
    return F.array_remove(chain, event)


def joined_record(events_: DataFrame) -> DataFrame:
    """FASTA text of the joined reads: id, description and sequence."""
    return events_.where("joined_sequence is not null").select(F.concat(F.lit(">"), "sequence_id", F.lit("-joined ForwardNs: "), "forward_ns", F.lit(", UMI: "), "umi", F.lit("\n"), "joined_sequence").alias("record"))
