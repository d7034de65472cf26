"""SentencePiece encoding and decoding over a relational lattice.

Text is cut into units that no piece crosses (a run of escaped blanks with the word behind it, or a line feed). The frequent
distinct units of the corpus are encoded relationally: their substrings of bounded length are exploded and equi-joined with
the piece table, the matching edges are grouped by unit, and a Spark ``aggregate`` folds each lattice to its pieces. For a
unigram model the fold is Viterbi (best sum of scores). The public model at hand is of the BPE kind, whose result is defined
by merging the best-scored adjacent pair again and again and is not the best path, so for it the fold carries the boundaries
and removes one per merge; both run over the same edges.

The encoded units are a dictionary of at most ``MOST_UNITS`` entries, a proven bound, which every task gets. Units beyond it
(rare words; about a tenth of all occurrences) are merged in the task, all distinct ones of a batch at once, by the same rule; units of
over ``LONGEST`` characters go to the library's encoder, as a lattice is quadratic in the length. Documents are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelattice.llm.words import let
from carelattice.runtime import cut_lineage

BLANK = "▁"
UNIT = f"{BLANK}*[^{BLANK}\n]+|\n|{BLANK}+"
MOST_UNITS = 200_000
LONGEST = 64
#: Documents whose distinct rare units are merged together.
SLICE = 512
#: Rare units a task remembers.
REMEMBERED = 100_000


@dataclass(frozen=True)
class Pieces:
    """Piece table of a model: (piece, score, id) of ordinary pieces; ``byte0`` is the id of byte 0."""

    path: str
    kind: str
    rows: tuple[tuple[str, float, int], ...]
    byte0: int

    @classmethod
    def load(cls, path: str) -> Pieces:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.trainer_spec.model_type not in (1, 2) or not model.trainer_spec.byte_fallback or model.normalizer_spec.name != "identity":
            raise ValueError("expected a unigram or BPE model with byte fallback and identity normalisation")
        rows = tuple((p.piece, p.score, i) for i, p in enumerate(model.pieces) if p.type == 1)
        byte0 = next(i for i, p in enumerate(model.pieces) if p.piece == "<0x00>")
        return cls(path, "bpe" if model.trainer_spec.model_type == 2 else "unigram", rows, byte0)

    @property
    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.rows)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.rows), "piece string, score double, id int")

    @cached_property
    def texts(self) -> list[bytes]:
        """UTF-8 of every id; control pieces are empty."""
        out = [b""] * (max(self.byte0 + 256, *(i + 1 for _, _, i in self.rows)))
        for b in range(256):
            out[self.byte0 + b] = bytes([b])
        for piece, _, i in self.rows:
            out[i] = piece.encode()
        return out


def public_pieces(path: str | None = None) -> Pieces:
    """Piece table of the model at ``path``, or of the public BPE model that is installed."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    return Pieces.load(str(path))


def units_of(text: Column) -> Column:
    """Array of units of a text; none for a null or empty one."""
    escaped = F.concat(F.lit(BLANK), F.replace(text, F.lit(" "), F.lit(BLANK)))
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.regexp_extract_all(escaped, F.lit(f"({UNIT})")))


def frequent_units(docs: DataFrame, most: int = MOST_UNITS) -> DataFrame:
    """(unit) of the most frequent distinct units of (text), whole counts first, ``most`` at the most.

    Units of equal count are taken or left together, so the result does not depend on the order of rows.
    """
    counted = docs.select(F.explode(units_of(F.col("text"))).alias("unit")).groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
    counts = cut_lineage(counted.where((F.col("n") > 1) & (F.length("unit") <= LONGEST)), "units")
    steps = counts.groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(F.count(F.lit(1)).alias("units")).orderBy(F.desc("n"))
    least, taken = 1 << 62, 0
    for row in steps.collect():
        taken += row["units"]
        if taken > most:
            break
        least = row["n"]
    return counts.where(F.col("n") >= least).select("unit")


def lattice(units: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, edges): all pieces that stand in a unit, as (start, end, score, id); units without any have no edges."""
    n = F.length("unit")
    starts = F.explode(F.sequence(F.lit(0), n - 1))
    cut = units.where(n > 0).select("unit", starts.alias("start"))
    cut = cut.select("unit", "start", F.explode(F.sequence(F.col("start") + 1, F.least(n, F.col("start") + pieces.longest))).alias("end"))
    cut = cut.withColumn("piece", F.substring("unit", F.col("start") + 1, F.col("end") - F.col("start")))
    found = cut.join(F.broadcast(pieces.table(units.sparkSession)), "piece", "left")
    edge = F.when(F.col("id").isNotNull(), F.struct("start", "end", "score", "id"))
    return found.groupBy("unit").agg(F.sort_array(F.collect_list(edge)).alias("edges"))


def _bytes_of(unit: Column, at: Column, byte0: int) -> Column:
    """Byte ids of the character of ``unit`` at index ``at``."""
    text = F.hex(F.encode(F.substring(unit, at + 1, F.lit(1)), "UTF-8"))
    return F.transform(F.sequence(F.lit(0), F.shiftright(F.length(text), 1) - 1), lambda k: (F.conv(F.substring(text, (2 * k + 1).cast("int"), F.lit(2)), 16, 10).cast("int") + byte0))


def fold_merges(unit: Column, edges: Column, byte0: int) -> Column:
    """Ids of a unit by merging, again and again, the adjacent pair with the best score, the leftmost of equals."""

    def between(known: Column, start: Column, end: Column) -> Column:
        return F.try_element_at(known, start * (LONGEST + 1) + end)

    def folded(known: Column) -> Column:
        def step(bounds: Column, _: Column) -> Column:
            inner = F.sequence(F.lit(1), F.greatest(F.size(bounds) - 2, F.lit(1)))
            pairs = F.transform(inner, lambda i: F.struct(between(known, F.get(bounds, i - 1), F.get(bounds, i + 1))["score"].alias("score"), (-i).alias("left")))
            best = F.array_max(F.filter(pairs, lambda p: p["score"].isNotNull()))
            return let(best, lambda b: F.when(b.isNull(), bounds).otherwise(F.filter(bounds, lambda _, k: k != -b["left"])))

        n = F.length(unit)
        bounds = F.aggregate(F.sequence(F.lit(1), n), F.sequence(F.lit(0), n), step)

        def ids(b: Column) -> Column:
            ends = F.slice(b, F.lit(2), F.size(b) - 1)
            each = F.transform(ends, lambda end, i: let(between(known, F.get(b, i), end)["id"], lambda found: F.when(found.isNotNull(), F.array(found)).otherwise(_bytes_of(unit, F.get(b, i), byte0))))
            return F.flatten(each)

        return let(bounds, ids)

    keyed = F.map_from_entries(F.transform(edges, lambda e: F.struct((e["start"] * (LONGEST + 1) + e["end"]).alias("key"), F.struct(e["score"].alias("score"), e["id"].alias("id")).alias("value"))))
    return let(keyed, folded)


def fold_viterbi(unit: Column, edges: Column, byte0: int, unknown: float) -> Column:
    """Ids of a unit along the path with the best sum of scores; a character without a piece costs ``unknown``."""
    cell = "struct<score:double,start:int,id:int>"

    def step(best: Column, end: Column) -> Column:
        into = F.transform(
            F.filter(edges, lambda e: e["end"] == end),
            lambda e: F.struct((F.get(best, e["start"])["score"] + e["score"]).alias("score"), e["start"].cast("int").alias("start"), e["id"].alias("id")).cast(cell),
        )
        single = F.struct((F.get(best, end - 1)["score"] + unknown).alias("score"), (end - 1).cast("int").alias("start"), F.lit(None).cast("int").alias("id")).cast(cell)
        known = F.exists(edges, lambda e: (e["end"] == end) & (e["start"] == end - 1))
        return F.concat(best, F.array(F.array_max(F.when(known, into).otherwise(F.concat(into, F.array(single))))))

    first = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(-1).alias("start"), F.lit(None).cast("int").alias("id")).cast(cell))
    cells = F.aggregate(F.sequence(F.lit(1), F.length(unit)), first, step)

    def back(best: Column) -> Column:
        start = F.struct(F.length(unit).alias("at"), F.array().cast("array<int>").alias("ids"))

        def take(acc: Column, _: Column) -> Column:
            got = F.get(best, acc["at"])
            ids = F.when(got["id"].isNotNull(), F.array(got["id"])).otherwise(_bytes_of(unit, got["start"], byte0))
            return F.when(acc["at"] <= 0, acc).otherwise(F.struct(got["start"].alias("at"), F.concat(ids, acc["ids"]).alias("ids")))

        return F.aggregate(F.sequence(F.lit(1), F.length(unit)), start, take, lambda acc: acc["ids"])

    return let(cells, back)


def encode_units(units: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, ids array<int>) for distinct units of up to LONGEST characters."""
    edges = lattice(units, pieces)
    if pieces.kind == "bpe":
        ids = fold_merges(F.col("unit"), F.col("edges"), pieces.byte0)
    else:
        ids = fold_viterbi(F.col("unit"), F.col("edges"), pieces.byte0, min(s for _, s, _ in pieces.rows) - 10)
    return edges.select("unit", ids.cast("array<int>").alias("ids"))


class Merger:
    """Encodes units beyond the dictionary: one merge of every open unit per pass over arrays."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        ids = {p: i for p, _, i in pieces.rows}
        self.symbol = dict(ids)
        self.next = len(pieces.texts)
        keys = []
        for piece, score, i in pieces.rows:
            for k in range(1, len(piece)):
                left, right = piece[:k], piece[k:]
                if (left in ids or len(left) == 1) and (right in ids or len(right) == 1):
                    keys.append(((self._symbol(left) << 32) | self._symbol(right), -score, i))
        keys.sort()
        self.keys = np.array([k for k, _, _ in keys], np.int64)
        self.cost = np.array([c for _, c, _ in keys], np.float64)
        self.into = np.array([i for _, _, i in keys], np.int64)

    def _symbol(self, part: str) -> int:
        """Id of a piece, or a number beyond all ids for a single character that is none."""
        if part not in self.symbol:
            self.symbol[part] = self.next
            self.next += 1
        return self.symbol[part]

    @cached_property
    def library(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=self.pieces.path)

    def _by_library(self, unit: str) -> bytes:
        # a line feed shields the unit from the blank that the library puts in front: two ids to drop
        return np.array(self.library.encode("\n" + unit.replace(BLANK, " "))[2:], np.int32).tobytes()

    def encode(self, units: list[str]) -> dict[str, bytes]:
        """Ids of distinct units as little-endian int32."""
        if self.pieces.kind != "bpe":
            return {u: self._by_library(u) for u in units}
        out = {u: self._by_library(u) for u in units if len(u) > LONGEST}
        units = [u for u in units if len(u) <= LONGEST]
        known = len(self.pieces.texts)
        names = {}
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        symbols = np.empty(int(sizes.sum()), np.int64)
        at = 0
        for u in units:
            for c in u:
                s = self.symbol.get(c)
                if s is None:
                    s = known + (1 << 20) + ord(c)
                if s >= known:
                    names[s] = c
                symbols[at] = s
                at += 1
        owner = np.repeat(np.arange(len(units)), sizes)
        done_symbols, done_owner = [], []
        while len(symbols):
            pair = (symbols[:-1] << 32) | symbols[1:]
            where = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            fits = (self.keys[where] == pair) & (owner[:-1] == owner[1:])
            cost = np.where(fits, self.cost[where], np.inf)
            if len(cost):
                firsts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                padded = np.append(cost, np.inf)
                least = np.minimum.reduceat(padded, firsts)
                spread = np.repeat(least, np.diff(np.append(firsts, len(symbols))))
                hit = np.flatnonzero(np.isfinite(padded) & (padded == spread))
                hit = hit[np.concatenate([[True], owner[hit][1:] != owner[hit][:-1]])] if len(hit) else hit
                open_ = np.isfinite(spread)
            else:
                hit, open_ = np.empty(0, np.int64), np.zeros(len(symbols), bool)
            done_symbols.append(symbols[~open_])
            done_owner.append(owner[~open_])
            symbols[hit] = self.into[where[hit]]
            keep = open_.copy()
            keep[hit + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        symbols = np.concatenate(done_symbols) if done_symbols else symbols
        owner = np.concatenate(done_owner) if done_owner else owner
        order = np.argsort(owner, kind="stable")
        symbols, owner = symbols[order], owner[order]
        strange = set(owner[symbols >= known].tolist())
        cuts = np.searchsorted(owner, np.arange(len(units) + 1))
        flat = symbols.astype(np.int32)
        for k, u in enumerate(units):
            part = flat[cuts[k] : cuts[k + 1]]
            if k in strange:
                part = np.array([i for s in symbols[cuts[k] : cuts[k + 1]].tolist() for i in ([self.pieces.byte0 + b for b in names[s].encode()] if s >= known else [s])], np.int32)
            out[u] = part.tobytes()
        return out


def decoded(ids: np.ndarray, texts: list[bytes]) -> str:
    """Text of a sequence of ids: the inverse of encoding for texts without the escape character."""
    text = b"".join([texts[i] for i in ids.tolist()]).decode("utf-8", "replace").replace(BLANK, " ")
    return text[1:] if text[:1] == " " else text


def encode(docs: DataFrame, pieces: Pieces, text: str = "text", ids: str = "piece_ids", most: int = MOST_UNITS) -> DataFrame:
    """``docs`` with ``ids`` (array<int>) and ``round_trip`` (decoding gives the text back).

    Equal to the library's encoding of every whole text. A null or empty text has no ids and round_trip true; a text with the
    escape character itself decodes to blanks and has round_trip false. Existing columns of these names are replaced.
    """
    spark = docs.sparkSession
    plain = docs.drop(ids, "round_trip")
    chosen = encode_units(frequent_units(plain.select(F.col(f"`{text}`").alias("text")), most), pieces)
    known = spark.sparkContext.broadcast({r["unit"]: np.array(r["ids"], np.int32).tobytes() for r in chosen.collect()})
    names = plain.columns
    schema = ", ".join(f"`{c}` {plain.schema[c].dataType.simpleString()}" for c in names) + f", `{ids}` array<int>, round_trip boolean"
    position = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units_in = re.compile(UNIT).findall
        table, merger, texts = known.value, Merger(pieces), pieces.texts
        rare: dict[str, bytes] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch = whole.slice(at, SLICE)
                originals = [t.as_py() or "" for t in batch.column(position)]
                cut = [units_in(BLANK + t.replace(" ", BLANK)) if t else [] for t in originals]
                if len(rare) > REMEMBERED:
                    rare.clear()
                rare |= merger.encode(list({u for units in cut for u in units if u not in table and u not in rare}))
                blobs = [b"".join([table[u] if u in table else rare[u] for u in units]) for units in cut]
                flat = np.frombuffer(b"".join(blobs), np.int32)
                ends = np.cumsum([0, *(len(b) // 4 for b in blobs)]).astype(np.int32)
                same = [decoded(flat[ends[i] : ends[i + 1]], texts) == t for i, t in enumerate(originals)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(same)], names=[*names, ids, "round_trip"]
                )

    return plain.mapInArrow(run, schema)


def decode(rows: DataFrame, pieces: Pieces, ids: str = "piece_ids", text: str = "text") -> DataFrame:
    """``rows`` with ``text`` decoded from ``ids``; null ids give null, an existing column of that name is replaced."""
    plain = rows.drop(text)
    names = plain.columns
    schema = ", ".join(f"`{c}` {plain.schema[c].dataType.simpleString()}" for c in names) + f", `{text}` string"
    position = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pieces.texts
        for batch in batches:
            out = [None if x.as_py() is None else decoded(np.array(x.as_py(), np.int64), texts) for x in batch.column(position)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*names, text])

    return plain.mapInArrow(run, schema)
