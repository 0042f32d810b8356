"""Best-fit packing by a grouping genetic algorithm on islands.

``token_pieces`` cuts documents into pieces of at most ``capacity`` tokens.
``pack`` puts the pieces into as few sequences as it can:

1. Pieces shorter than the capacity are dealt into disjoint shards of about
   ``shard_items`` pieces (only ids and lengths are shuffled).  Each task deals
   its pieces out in order of length, so all shards get the same mix of lengths
   and lose little against packing everything at once.
2. Every shard is evolved by several islands.  An individual is a list of
   bins; crossover injects whole well-filled bins of one parent into the
   other, removes the bins with duplicate pieces and best-fits the displaced
   pieces; mutation empties the worst bins and best-fits their pieces.
3. After an epoch each island sends its best individual to the next island
   (a shuffle by shard and island); after the last epoch the best individual of
   a shard wins.
4. Bins of a shard that are not well filled are opened again and their pieces
   packed in a further round with fewer, re-mixed shards.

Every step is a deterministic function of its group, so a lost executor's
groups give the same bins when they run again.
"""

from __future__ import annotations

import random
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm import codec
from matchlake.llm.common import arrow_schema, read_table, save

CAPACITY = 1024
END_ID = 2


def piece_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces: only the first may be shorter than the capacity."""
    first = n % capacity
    return ([first] if first else []) + [capacity] * (n // capacity)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY,
                 end_id: int = END_ID) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document of (doc_id, text).

    A null text counts as empty: its only token is the end id.  Repeated rows
    give their pieces again; an empty table gives no rows.
    """
    source = docs.select("doc_id", "text")
    schema = T.StructType([
        T.StructField("doc_id", source.schema["doc_id"].dataType),
        T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    out = arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec.byte_bpe(tokenizer)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = np.append(bpe.ids(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                at = 0
                for k, n in enumerate(piece_lengths(len(ids), capacity)):
                    row.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(ids[at:at + n]))
                    at += n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())).cast(out.field(0).type),
                 pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], schema=out)

    return source.mapInArrow(cut, schema)


class Packer:
    """Bins under best fit: the fullest open bin that still has room takes a piece."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity

    def fill(self, bins: list[list[int]], items: list[int]) -> list[list[int]]:
        """Best-fits ``items`` in the given order into ``bins`` (extended in place)."""
        lengths, cap = self.lengths, self.capacity
        by_room: list[list[int]] = [[] for _ in range(cap + 1)]
        open_rooms = 0  # bit r: some bin has room r
        for b, content in enumerate(bins):
            room = cap - sum(lengths[i] for i in content)
            by_room[room].append(b)
            open_rooms |= 1 << room
        for i in items:
            n = lengths[i]
            fits = open_rooms >> n
            if fits:
                room = n + (fits & -fits).bit_length() - 1
                b = by_room[room].pop()
                if not by_room[room]:
                    open_rooms ^= 1 << room
                bins[b].append(i)
            else:
                room, b = cap, len(bins)
                bins.append([i])
            by_room[room - n].append(b)
            open_rooms |= 1 << (room - n)
        return bins

    def fitness(self, bins: list[list[int]]) -> float:
        """Mean squared fill: fewer and more unevenly filled bins are better."""
        lengths, cap = self.lengths, self.capacity
        return sum((sum(lengths[i] for i in b) / cap) ** 2 for b in bins) / max(1, len(bins))

    def greedy(self, rng: random.Random | None = None, spread: float = 0.0) -> list[list[int]]:
        """Best fit by decreasing length; ``spread`` perturbs the order."""
        noise = (lambda: 1 + spread * rng.random()) if rng else (lambda: 1.0)
        order = sorted(range(len(self.lengths)), key=lambda i: (-self.lengths[i] * noise(), i))
        return self.fill([], order)

    def cross(self, a: list[list[int]], b: list[list[int]], rng: random.Random,
              share: float) -> list[list[int]]:
        """Injects a section of b's fullest bins into a and best-fits what they displace."""
        lengths = self.lengths
        ranked = sorted(range(len(b)), key=lambda k: -sum(lengths[i] for i in b[k]))
        width = max(1, int(len(ranked) * share))
        first = rng.randrange(max(1, len(ranked) // 2 - width + 1))
        injected = [list(b[k]) for k in ranked[first:first + width]]
        taken = {i for content in injected for i in content}
        kept, loose = [], []
        for content in a:
            if taken.isdisjoint(content):
                kept.append(list(content))
            else:
                loose += [i for i in content if i not in taken]
        loose.sort(key=lambda i: (-lengths[i], i))
        return self.fill(kept + injected, loose)

    def mutate(self, a: list[list[int]], rng: random.Random, share: float) -> list[list[int]]:
        """Empties the worst bins and a few random ones, then best-fits their pieces."""
        lengths = self.lengths
        ranked = sorted(range(len(a)), key=lambda k: sum(lengths[i] for i in a[k]))
        count = max(1, int(len(ranked) * share))
        out = set(ranked[:count]) | {rng.randrange(len(a)) for _ in range(count)}
        loose = [i for k in out for i in a[k]]
        loose.sort(key=lambda i: (-lengths[i], i))
        return self.fill([list(c) for k, c in enumerate(a) if k not in out], loose)

    def evolve(self, seeds: list[list[list[int]]], rng: random.Random, generations: int,
               population: int) -> list[list[int]]:
        """Steady-state generations over the given individuals; returns the best."""
        people = [(self.fitness(s), s) for s in seeds]
        while len(people) < population:
            s = self.greedy(rng, 0.05 * len(people))
            people.append((self.fitness(s), s))
        for g in range(generations):
            people.sort(key=lambda p: -p[0])
            best, other = people[0][1], people[1 + rng.randrange(len(people) - 1)][1]
            pair = (best, other) if g % 2 == 0 else (other, best)
            child = self.mutate(self.cross(*pair, rng, 0.15), rng, 0.02)
            people[-1] = max(people[-1], (self.fitness(child), child), key=lambda p: p[0])
        return max(people, key=lambda p: p[0])[1]


def _bins_of(column: np.ndarray) -> list[list[int]]:
    order = np.argsort(column, kind="stable")
    cuts = np.flatnonzero(np.diff(column[order])) + 1
    return [part.tolist() for part in np.split(order, cuts)]


def evolve_shards(items: DataFrame, shards: int, capacity: int, islands: int, epochs: int,
                  generations: int, population: int, seed: int) -> DataFrame:
    """(uid, length) -> (uid, length, shard, bin, fill): the best individual of every shard."""
    state = T.StructType([T.StructField(n, T.LongType())
                          for n in ("uid", "length", "shard", "island", "role", "bin")])
    final = T.StructType([T.StructField(n, T.LongType())
                          for n in ("uid", "length", "shard", "bin", "offset", "fill")])

    def epoch(number: int):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            shard, island = int(pdf["shard"].iat[0]), int(pdf["island"].iat[0])
            pdf = pdf.sort_values(["role", "uid"], kind="stable")
            own = pdf[pdf["role"] == 0]
            packer = Packer(own["length"].tolist(), capacity)
            rng = random.Random(f"{seed}/{shard}/{island}/{number}")
            if number == 0:
                seeds = [packer.greedy(rng if island else None, 0.02 * island)]
            else:
                seeds = [_bins_of(part["bin"].to_numpy())
                         for _, part in pdf.groupby("role", sort=True)]
            best = packer.evolve(seeds, rng, generations, population)
            number_of = np.zeros(len(own), np.int64)
            for b, content in enumerate(best):
                number_of[content] = b
            return own.assign(role=0, bin=number_of)[state.names]
        return run

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        candidates = []
        for island, part in pdf.groupby("island", sort=True):
            part = part.sort_values(["bin", "uid"], kind="stable")
            packer = Packer(part["length"].tolist(), capacity)
            bins = _bins_of(part["bin"].to_numpy())
            candidates.append((len(bins), -packer.fitness(bins), island, part))
        part = min(candidates, key=lambda c: c[:3])[3]
        lengths = part.groupby("bin")["length"]
        return part.assign(offset=lengths.cumsum() - part["length"],
                           fill=lengths.transform("sum"))[final.names]

    at = F.monotonically_increasing_id()  # position in the sorted partition, below bit 33
    place = at.bitwiseAND((1 << 33) - 1) + F.shiftright(at, 33) * 7919
    pool = (items.sortWithinPartitions("length", "uid")
            .withColumn("shard", F.pmod(place, F.lit(shards)))
            .withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
            .select("uid", "length", "shard", F.col("island").cast("long").alias("island"),
                    F.lit(0).cast("long").alias("role"), F.lit(0).cast("long").alias("bin")))
    for number in range(epochs):
        if number and islands > 1:  # the elite of island k also goes to island k + 1
            visit = F.array(F.struct(F.col("island").alias("island"), F.lit(0).alias("role")),
                            F.struct(((F.col("island") + 1) % islands).alias("island"),
                                     F.lit(1).alias("role")))
            pool = (pool.drop("role").withColumnRenamed("island", "from_island")
                    .withColumn("island", F.col("from_island"))
                    .withColumn("to", F.explode(visit))
                    .select("uid", "length", "shard", F.col("to.island").alias("island"),
                            F.col("to.role").cast("long").alias("role"), "bin"))
        pool = pool.groupBy("shard", "island").applyInPandas(epoch(number), state)
    return pool.groupBy("shard").applyInPandas(choose, final)


def pack(pieces: DataFrame, capacity: int = CAPACITY, shard_items: int = 4096, islands: int = 2,
         epochs: int = 2, generations: int = 6, population: int = 4, rounds: int = 3,
         well_filled: float = 0.998) -> DataFrame:
    """Adds sequence_id and offset to the pieces (any frame with a ``length`` column).

    A piece of full length is a sequence of its own.  Lengths must lie in
    1..capacity.  Repeated rows are packed as separate pieces; an empty table
    gives no rows.  Columns of the input are kept, also ones named like the
    working columns here.
    """
    keyed = save(pieces.select(F.struct("*").alias("row"), F.col("length").alias("length"),
                               F.monotonically_increasing_id().alias("uid")), "pieces")
    todo = keyed.filter(F.col("length") < capacity).select("uid", "length")
    count, placed = todo.count(), []
    for r in range(rounds):
        shards = max(1, -(-count // shard_items))
        best = save(evolve_shards(todo, shards, capacity, islands, epochs, generations,
                                  population, seed=r), f"packed{r}")
        last = r == rounds - 1 or shards == 1
        done = best if last else best.filter(F.col("fill") >= int(well_filled * capacity))
        number = F.lit(r * (1 << 48)) + F.col("shard") * (1 << 20) + F.col("bin")
        placed.append(done.select("uid", (number * 2 + 1).alias("sequence_id"), "offset"))
        if last:
            break
        todo = best.filter(F.col("fill") < int(well_filled * capacity)).select("uid", "length")
        count = todo.count()
    where = placed[0]
    for p in placed[1:]:
        where = where.unionAll(p)
    return keyed.join(where, "uid", "left").select(
        "row.*", F.coalesce("sequence_id", F.col("uid") * 2).alias("sequence_id"),
        F.coalesce("offset", F.lit(0).cast("long")).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Tokenizes, cuts and packs whole documents: the rows of the op4 contract."""
    path = tokenizer or codec.tokenizer_path("byte_bpe_50k.json")
    return pack(token_pieces(docs, path))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))
