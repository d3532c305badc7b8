"""N-gram Jaccard join: groups of documents whose sets of word n-grams are alike, exactly.

A document's set holds the distinct runs of ``size`` words of its whole text; two sets link when their Jaccard likeness
is at least ``percent`` / 100.  The join is a rare-first prefix filter:

1. One pass makes each document's set.  Equal sets form a class, so copies cost one row.  The pass also counts n-grams in
   a sketch of fixed size; an n-gram whose counter is far above the mean is *frequent* and ranks by that counter.
2. All other n-grams are dealt by their leading bits and counted exactly, over classes.  An n-gram of a single class can
   not link anything and goes no further.
3. Back at its class, a set is ordered by (count, hash).  Linked sets share an n-gram among the first
   ``n - ceil(n * percent / 100) + 1`` of that order; a class with as many n-grams of its own has no link at all.
4. Pairs of classes meet on n-grams of their prefixes, under the length and the positional filter.  Of the pairs of an
   n-gram only those between different components are made: the first rounds compare with a few hubs each n-gram, and
   what a round links needs no further pair.  What a class shares with another component after that
   is settled block by block against the component's members, without a row for each pair.
5. Each pair is verified once, with the whole sets: the suffix filter (n-grams in 16 ranges of the hash space) first, then
   the exact intersection.

Defined results: a text that is null or has no words has an empty set, links with nothing and is its own component.  A
null id links nothing and has a null component.  Repeated ids name a document each; the component is the least id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockloom.llm import sketch
from blockloom.llm.components import components
from blockloom.llm.tables import Carried, each_batch, give_back, pick, stored
from blockloom.llm.words import shingles, word_hashes

#: N-grams that one part or chunk holds on average.
PART_NGRAMS = 1_500_000
MIN_PARTS = 64
RANGES = 16
HUBS, HUB_ROUNDS, BLOCK = 3, 3, 128


def _sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    for at, hashes, ends in word_hashes(column, lower=True):
        for i in range(len(ends) - 1):
            yield at + i, np.unique(shingles(hashes[ends[i] : ends[i + 1]], size))


def _class_of(ngrams: np.ndarray, salt: int) -> int:
    return int.from_bytes(hashlib.blake2b(ngrams.tobytes(), digest_size=16, salt=salt.to_bytes(8, "little")).digest()[:8], "little", signed=True)


def _digest(ngrams: np.ndarray) -> bytes:
    return hashlib.blake2b(ngrams.tobytes(), digest_size=16).digest()


def _base(size: int, salt: int):
    """Rows of documents (id, th, n, cls, digest) and, at the end of a task, the slices of its counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << sketch.BITS, np.int64)
        for batch in batches:
            n, cls, digest = [0] * batch.num_rows, [0] * batch.num_rows, [b""] * batch.num_rows
            for i, own in _sets(batch["text"], size):
                n[i], cls[i], digest[i] = len(own), _class_of(own, salt), _digest(own)
                np.add.at(total, sketch.counter_of(own), 1)
            k = batch.num_rows
            yield pa.RecordBatch.from_pydict(
                {"id": batch["id"], "th": batch["th"], "n": pa.array(n, pa.int64()), "cls": pa.array(cls, pa.int64()), "digest": pa.array(digest, pa.binary()), "slice": pa.nulls(k, pa.int32()), "counts": pa.nulls(k, pa.binary())}
            )
        give_back()
        for part in sketch.rows(total):
            k = part.num_rows
            yield pa.RecordBatch.from_pydict(
                {"id": pa.nulls(k, pa.int64()), "th": pa.nulls(k, pa.int64()), "n": pa.nulls(k, pa.int64()), "cls": pa.nulls(k, pa.int64()), "digest": pa.nulls(k, pa.binary()), "slice": part["slice"], "counts": part["counts"]}
            )

    return run


def _forward(size: int, salt: int, parts: int, counters: np.ndarray, frequent_from: int):
    """Each batch's n-grams, packed by part: classes, set sizes, n-grams of each class here, and the n-grams."""
    scale = np.uint64((1 << 64) // parts + 1)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        seen, cls, sizes, sets = set(), [], [], []
        for i, own in _sets(batch["text"], size):
            c = _class_of(own, salt)
            if len(own) and batch["id"][i].is_valid and c not in seen:
                seen.add(c)
                cls.append(c)
                sizes.append(len(own))
                sets.append(own)
        if not sets:
            return None
        cls, sizes, grams = np.array(cls, np.int64), np.array(sizes, np.int64), np.concatenate(sets)
        owner = np.repeat(np.arange(len(cls)), sizes)
        part = (grams // scale).astype(np.int64)
        frequent = counters[sketch.counter_of(grams)] >= frequent_from
        part[frequent] = cls.view(np.uint64)[owner[frequent]] // scale  # a frequent n-gram needs no count: dealt by its class
        group = part * 2 + frequent
        order = np.argsort(group, kind="stable")
        grams, owner, group = grams[order], owner[order], group[order]
        edges = np.flatnonzero(np.diff(group, prepend=-1))
        out: dict[str, list] = {k: [] for k in ("part", "frequent", "cls", "sizes", "counts", "grams")}
        for a, b in zip(edges, [*edges[1:], len(group)]):
            who, counts = np.unique(owner[a:b], return_counts=True)
            for k, v in (("part", int(group[a] >> 1)), ("frequent", bool(group[a] & 1)), ("cls", cls[who].tobytes()), ("sizes", sizes[who].tobytes()), ("counts", counts.astype(np.int32).tobytes()), ("grams", grams[a:b].tobytes())):
                out[k].append(v)
        return pa.RecordBatch.from_pydict(out, schema=pa.schema([("part", pa.int64()), ("frequent", pa.bool_()), ("cls", pa.binary()), ("sizes", pa.binary()), ("counts", pa.binary()), ("grams", pa.binary())]))

    return each_batch(work)


def _counted(parts: int, counters: np.ndarray):
    """Of one part: the n-grams of two or more classes with their counts, packed by chunk of classes."""
    scale = np.uint64((1 << 64) // parts + 1)

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        def gathered(own: pd.DataFrame) -> tuple[np.ndarray, ...]:
            counts = [np.frombuffer(x, np.int32) for x in own["counts"]]
            join = lambda name, kind: np.concatenate([np.repeat(np.frombuffer(x, kind), c) for x, c in zip(own[name], counts)] or [np.zeros(0, kind)])
            return join("cls", np.int64), join("sizes", np.int64), np.concatenate([np.frombuffer(x, np.uint64) for x in own["grams"]] or [np.zeros(0, np.uint64)])

        cls, sizes, grams = gathered(rows[~rows["frequent"]])
        order = np.argsort(grams, kind="stable")
        cls, sizes, grams = cls[order], sizes[order], grams[order]
        same = grams[1:] == grams[:-1]
        keep = np.zeros(len(grams), bool)
        keep[1:] |= same
        keep[:-1] |= same
        cls, sizes, grams = cls[keep], sizes[keep], grams[keep]
        order = np.lexsort((cls, grams))
        cls, sizes, grams = cls[order], sizes[order], grams[order]
        first = np.ones(len(grams), bool)  # a class that came in several batches counts once
        first[1:] = (grams[1:] != grams[:-1]) | (cls[1:] != cls[:-1])
        cls, sizes, grams = cls[first], sizes[first], grams[first]
        _, where, df = np.unique(grams, return_inverse=True, return_counts=True)
        df = df[where] if len(grams) else np.zeros(0, np.int64)
        shared = df >= 2
        more = gathered(rows[rows["frequent"]])
        cls, sizes, grams = (np.concatenate([x[shared], y]) for x, y in zip((cls, sizes, grams), more))
        df = np.concatenate([df[shared], counters[sketch.counter_of(more[2])]])
        order = np.lexsort((grams, cls))
        cls, sizes, grams, df = cls[order], sizes[order], grams[order], df[order]
        chunk = (cls.view(np.uint64) // scale).astype(np.int64)
        order = np.argsort(chunk, kind="stable")
        cls, sizes, grams, df, chunk = (x[order] for x in (cls, sizes, grams, df, chunk))
        edges = np.flatnonzero(np.diff(chunk, prepend=-1))
        out = []
        for a, b in zip(edges, [*edges[1:], len(chunk)]):
            starts = np.flatnonzero(np.concatenate([[True], cls[a + 1 : b] != cls[a : b - 1]])) + a
            counts = np.diff(np.concatenate([starts, [b]])).astype(np.int32)
            out.append((int(chunk[a]), cls[starts].tobytes(), sizes[starts].tobytes(), counts.tobytes(), grams[a:b].tobytes(), df[a:b].astype(np.int64).tobytes()))
        del cls, sizes, grams, df, chunk, order, more
        give_back()
        return pd.DataFrame(out, columns=["chunk", "cls", "sizes", "counts", "grams", "df"])

    return run


def _prefixes(percent: int):
    """Of one chunk of classes: those with n-grams of others in their prefix, as (cls, n, own, prefix, shared)."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        counts = [np.frombuffer(x, np.int32) for x in rows["counts"]]
        cls = np.concatenate([np.repeat(np.frombuffer(x, np.int64), c) for x, c in zip(rows["cls"], counts)])
        sizes = np.concatenate([np.repeat(np.frombuffer(x, np.int64), c) for x, c in zip(rows["sizes"], counts)])
        grams = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["grams"]])
        df = np.concatenate([np.frombuffer(x, np.int64) for x in rows["df"]])
        order = np.lexsort((grams, df, cls))
        cls, sizes, grams, df = cls[order], sizes[order], grams[order], df[order]
        fresh = np.ones(len(cls), bool)  # frequent n-grams of a class that came in several batches
        fresh[1:] = (cls[1:] != cls[:-1]) | (grams[1:] != grams[:-1])
        cls, sizes, grams = cls[fresh], sizes[fresh], grams[fresh]
        starts = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]]))
        ends = np.concatenate([starts[1:], [len(cls)]])
        out = []
        for a, b in zip(starts, ends):
            n = int(sizes[a])
            own = n - int(b - a)
            prefix = n - -(-n * percent // 100) + 1
            if own < prefix:
                out.append((int(cls[a]), n, own, grams[a : a + prefix - own].view(np.int64).copy(), np.sort(grams[a:b]).tobytes()))
        del cls, sizes, grams, df, order, counts
        give_back()
        return pd.DataFrame(out, columns=["cls", "n", "own", "prefix", "shared"])

    return run


def _verified(percent: int):
    """Pairs (a, b) whose sets have the likeness, after the suffix filter."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for i, (na, nb, sa, sb) in enumerate(zip(*(batch[k].to_pylist() for k in ("na", "nb", "sa", "sb")))):
            x, y = np.frombuffer(sa, np.uint64), np.frombuffer(sb, np.uint64)
            need = -(-percent * (na + nb) // (100 + percent))
            most = np.minimum(np.bincount(x >> np.uint64(60), minlength=RANGES), np.bincount(y >> np.uint64(60), minlength=RANGES)).sum()
            if most >= need and len(np.intersect1d(x, y, assume_unique=True)) >= need:
                keep.append(i)
        return batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    return each_batch(work)


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    a = sets.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"))
    b = sets.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("shared").alias("sb"))
    return pairs.join(a, "a").join(b, "b").mapInArrow(_verified(percent), "a bigint, b bigint")


def _block_verified(percent: int):
    """Links (a, b) of a class with the members of a block."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found_a, found_b = [], []
        for a, na, sa, members in zip(*(batch[k].to_pylist() for k in ("a", "na", "sa", "members"))):
            x = np.frombuffer(sa, np.uint64)
            near = [m for m in members if 100 * min(na, m["n"]) >= percent * max(na, m["n"])]
            if not near or not len(x):
                continue
            sizes = [len(m["shared"]) // 8 for m in near]
            every = np.frombuffer(b"".join(m["shared"] for m in near), np.uint64)
            place = np.minimum(np.searchsorted(x, every), len(x) - 1)
            ends = np.cumsum([0, *sizes])
            hits = np.concatenate([[0], np.cumsum(x[place] == every)])
            for m, both in zip(near, hits[ends[1:]] - hits[ends[:-1]]):
                if m["cls"] != a and 100 * both >= percent * (na + m["n"] - both):
                    found_a.append(a)
                    found_b.append(m["cls"])
        return pa.RecordBatch.from_pydict({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return each_batch(work)


def _placed(classes: DataFrame) -> DataFrame:
    """``classes`` with the block that holds each: blocks of a component, or of lone classes with the same last n-gram."""
    alone = F.col("comp") == F.col("cls")
    family = classes.groupBy("comp").agg(F.count("*").alias("m"))
    classes = classes.join(family, "comp").withColumn("family", F.when(alone & (F.col("m") == 1), F.struct(F.lit(True).alias("lone"), F.element_at("prefix", -1).alias("name"))).otherwise(F.struct(F.lit(False).alias("lone"), F.col("comp").alias("name"))))
    sizes = classes.groupBy("family").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    return classes.join(sizes, "family").select("cls", "n", "own", "comp", "prefix", F.struct("family.lone", "family.name", F.pmod(F.xxhash64("cls"), F.col("blocks")).alias("part")).alias("block"))


def _block_links(asked: DataFrame, placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of classes ``a`` with members of the blocks they are asked for."""
    wanted = placed.select("cls", "block").join(asked.select("block").distinct(), "block", "left_semi")
    blocks = wanted.join(sets.select("cls", "n", "shared"), "cls").groupBy("block").agg(F.collect_list(F.struct("cls", "n", "shared")).alias("members"))
    a = sets.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("shared").alias("sa"))
    return asked.join(a, "a").join(blocks, "block").select("a", "na", "sa", "members").mapInArrow(_block_verified(percent), "a bigint, b bigint")


def _may_link(percent: int, x: str, y: str) -> str:
    """SQL for the length and the positional filter between two prefix entries."""
    need = f"CEIL({percent} * ({x}n + {y}n) / {100 + percent}D)"
    return (
        f"100 * LEAST({x}n, {y}n) >= {percent} * GREATEST({x}n, {y}n) AND "
        f"LEAST({x}n - {x}at, {y}n - {y}at) + LEAST({x}at, {y}at) >= {need}"
    )


def similar_classes(sets: DataFrame, percent: int) -> DataFrame:
    """(node, root) of all linked classes."""
    found, tried, labels = None, None, None
    for turn in range(HUB_ROUNDS):
        classes = sets.select("cls", "n", "own", "prefix", F.col("cls").alias("comp"))
        if labels is not None:
            own = labels.select(F.col("node").alias("cls"), F.col("root").alias("comp"))
            classes = classes.drop("comp").join(own, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        now = classes.selectExpr("cls", "n", "own", "comp", "posexplode(prefix) AS (i, gram)").selectExpr("gram", "cls", "n", "own + i AS at", "comp")
        hubs = [F.min(F.struct(F.xxhash64("cls", F.lit(turn * HUBS + k)).alias("h"), "cls", "n", "at")).alias(f"hub{k}") for k in range(HUBS)]
        by_comp = now.groupBy("gram", "comp").agg(F.count("*").alias("m"), *hubs)
        main = F.max(F.struct("m", "comp", *[f"hub{k}" for k in range(HUBS)])).alias("main")
        by_gram = by_comp.groupBy("gram").agg(F.sum("m").alias("m"), F.count("*").alias("comps"), main).where("comps > 1")
        open_grams = stored(by_gram.select("gram", "m", "main.*").toDF("gram", "all", "most", "main", *[f"hub{k}" for k in range(HUBS)]))
        size = open_grams.agg(F.sum("all"), F.sum(F.expr("(all - most) * all"))).first()
        if not size[0]:
            break
        last = turn == HUB_ROUNDS - 1 or size[1] <= 8 * size[0]
        if last:  # whole blocks of classes against the classes that share an n-gram with them
            placed = stored(_placed(classes))
            here = placed.selectExpr("cls", "n", "own", "comp", "block", "posexplode(prefix) AS (i, gram)").selectExpr("gram", "cls", "n", "own + i AS at", "comp", "block")
            here = stored(here.join(open_grams.select("gram", "main"), "gram"))
            x = here.where("comp <> main").select("gram", F.col("cls").alias("a"), "n", "at", F.col("comp").alias("xcomp"), F.col("block").alias("xblock"))
            y = here.groupBy("gram", "block").agg(*[F.expr(e) for e in ("min(n) AS least", "max(n) AS most", "max(n - at) AS rest", "max(at) AS last", "min(comp) AS first", "bool_or(comp = main) AS main")])
            # the filters of a pair, for the member of the block that passes them most easily
            may = f"100 * LEAST(n, most) >= {percent} * GREATEST(n, least) AND LEAST(n - at, rest) + LEAST(at, last) >= CEIL({percent} * (n + least) / {100 + percent}D)"
            asked = stored(x.join(y, "gram").where(f"(block.lone OR xcomp <> first) AND (main OR xblock <= block) AND {may}").select("a", "block").distinct())
            new = stored(_block_links(asked, placed, sets, percent))
            if not new.isEmpty():
                labels = components(new if found is None else found.union(new))
            break
        now = stored(now.join(open_grams, "gram"))
        # some classes of the main component, others each round, against those outside it
        hub = F.explode(F.array(*[f"hub{k}" for k in range(HUBS)])).alias("hub")
        pairs = now.where("comp <> main").select("cls", "n", "at", hub).select("cls", "n", "at", F.col("hub.cls").alias("hcls"), F.col("hub.n").alias("hn"), F.col("hub.at").alias("hat"))
        pairs = pairs.where(_may_link(percent, "", "h")).selectExpr("LEAST(cls, hcls) AS a", "GREATEST(cls, hcls) AS b")
        pairs = pairs.distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs)
        new = stored(_links(pairs, sets, percent))
        tried = pairs if tried is None else stored(tried.union(pairs))
        if not new.isEmpty():
            found = new if found is None else found.union(new)
            labels = components(found)
    return labels if labels is not None else sets.selectExpr("cls AS node", "cls AS root").limit(0)


def _components(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, th, n, component) of every row of ``docs`` (id, text, th)."""
    texts = docs.select("id", "text")
    schema = "id bigint, th bigint, n bigint, cls bigint, digest binary, slice int, counts binary"
    for salt in range(16):
        both = stored(docs.mapInArrow(_base(size, salt), schema))
        base = both.where("n IS NOT NULL").select("id", "th", "n", "cls", "digest")
        if base.groupBy("cls").agg(F.min("digest").alias("a"), F.max("digest").alias("b")).where("a <> b").isEmpty():
            break  # classes have names of their own; else the next salt
    counters = sketch.gather(both.where("slice IS NOT NULL"))
    total = int(counters.sum())
    frequent_from = 4 * total // len(counters) + 1000
    parts = max(MIN_PARTS, total // PART_NGRAMS)
    forward = texts.mapInArrow(_forward(size, salt, parts, counters, frequent_from), "part bigint, frequent boolean, cls binary, sizes binary, counts binary, grams binary")
    packed = "chunk bigint, cls binary, sizes binary, counts binary, grams binary, df binary"
    counted = forward.groupBy("part").applyInPandas(_counted(parts, counters), packed)
    sets = stored(counted.groupBy("chunk").applyInPandas(_prefixes(percent), "cls bigint, n bigint, own bigint, prefix array<bigint>, shared binary"))
    labels = similar_classes(sets, percent)
    linked = base.where("n > 0 AND id IS NOT NULL")
    classes = linked.groupBy("cls").agg(F.min("id").alias("least"))
    classes = classes.join(labels.select(F.col("node").alias("cls"), "root"), "cls", "left").select("cls", "least", F.coalesce("root", "cls").alias("root"))
    classes = stored(classes)
    roots = classes.groupBy("root").agg(F.min("least").alias("component"))
    classes = stored(classes.join(roots, "root").select("cls", "component"))
    alone = base.where("NOT (n > 0 AND id IS NOT NULL)").select("id", "th", "n", F.col("id").alias("component"))
    return linked.join(classes, "cls").select("id", "th", "n", "component").unionByName(alone)


def similar_documents(docs: DataFrame, size: int = 5, percent: int = 75, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``: the size of its set and the least id of its group."""
    rows = pick(docs, id=id, text=text).select(F.col("id").cast("bigint"), F.col("text").cast("string")).withColumn("th", F.xxhash64("text"))
    return _components(rows, size, percent).select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 75, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group, that with the least id; rows equal in id and text count once.

    Documents without words and those without an id are in no group and stay.
    """
    held = Carried(docs, id=id, text=text)
    rows = held.df.withColumns({"id": F.col("id").cast("bigint"), "text": F.col("text").cast("string"), "th": F.xxhash64("text")})
    groups = _components(rows.select("id", "text", "th"), size, percent)
    first = groups.where("id = component OR id IS NULL").select(F.col("id").alias("gid"), F.col("th").alias("gth")).distinct()
    kept = rows.join(first, F.col("id").eqNullSafe(F.col("gid")) & (F.col("th") == F.col("gth")), "left_semi")
    unnamed = kept.where("id IS NULL")
    return held.back(kept.where("id IS NOT NULL").dropDuplicates(["id", "th"]).unionByName(unnamed))
