"""N-gram Jaccard self-join over count vectors.

A document is the set of its distinct word n-grams.  Every n-gram falls into a
group by its hash, and the group counts are the document's point.  For two sets
the sum over groups of the smaller count bounds the overlap from above, so pairs
that cannot reach the threshold fall without their texts being touched.  The
points are indexed as a forest:

* directory: the groups of a document are dealt into m blocks.  Two sets within
  the threshold differ in at most d elements, each of which spoils one block, so
  at least m - d blocks are equal.  A document enters the directory under the
  content of each block, and then leaves out up to D = (m - d - 1) / 2 of its
  entries, those in the fullest buckets (d for its own size, the worst over its
  partners): blocks that consist of common passages go, and since both partners
  together leave out fewer than m - d, one equal block is always left to meet in.
* leaves: inside a bucket, points are packed into leaves of ``LEAF`` with their
  bounding corner; pairs of leaves, then pairs of points are dropped by the bound.
* survivors meet the bound on their full points, and then are verified exactly
  on the sets.

Copies: equal sets are one node, so copies are never paired.  Groups of near
copies: first every bucket pairs its members with one leader, and the links found
join into components.  In buckets whose other members still belong to several
components, every set then meets the partner of another component with the
highest bound in each leaf.  Only what is still apart after that is searched in full, between
components alone.  So no link between components is missed, and a large group costs
some comparisons a member, not all pairs.

Sizes: m and d depend on the size band (ratio ``BAND``) of the smaller set; a
document enters its own band and, where its partner may be smaller, the one
below.  Sets of up to five n-grams or so (d = 0) meet only their equals.

Threshold: ``percent`` in hundredths, compared in whole numbers.  Hashes of n-grams
are 64 bits.  A set's id is 64 bits with a second hash of 64 beside it: where two
differing sets share an id, both go by the second.

Texts are read three times: for sizes and ids, for the directory, and, of the sets
that share a bucket, for their points and elements, which are written once.

Defined cases: null, empty and blank texts have the empty set, link with nothing
and are their own component; rows repeated are one node; a component's id is its
smallest non-null id; null ids take part and get the component's id; an empty
table gives an empty result; other columns are ignored, and :func:`keep_one`
hands them through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.components import components
from docketry.llm.shingles import fingerprint, mix, second_print, shingle_sets
from docketry.llm.sieve import among, passed, places, sieve
from docketry.session import ship_package, unused, write_shared

BAND = 1.7
LEAF = 64
COARSE = 128
BANDS = 60
KEYS = 16
BATCH_BYTES = 8_000_000


def band_limits(band: int) -> tuple[int, int]:
    """Smallest and largest size of a band."""
    return math.ceil(BAND**band - 1e-9), math.ceil(BAND ** (band + 1) - 1e-9) - 1


def band_of(n: int) -> int:
    band = int(math.log(max(n, 1)) / math.log(BAND))
    while band_limits(band)[0] > n:
        band -= 1
    while band_limits(band)[1] < n:
        band += 1
    return band


def most_different(total: int, percent: int) -> int:
    """Most elements by which two sets of ``total`` elements together may differ."""
    return total * (100 - percent) // (100 + percent)


def plan(band: int, percent: int) -> int:
    """Blocks of a band; 0 where only equal sets are within the threshold."""
    top = band_limits(band)[1]
    d = most_different(top + top * 100 // percent, percent)
    return d + 1 + 2 * (1 + d // 10) if d > 0 else 0


def left_out(n: int, band: int, percent: int) -> int:
    """Entries a set of n may leave out in a band (its own, or the one below)."""
    top = band_limits(band)[1]
    partner = n * 100 // percent if n <= top else top
    return max(0, (plan(band, percent) - most_different(n + partner, percent) - 1) // 2)


def directory_keys(s: np.ndarray, percent: int, plans: dict[int, int]) -> np.ndarray:
    """Signed 64-bit bucket keys of a set; the low byte is the band."""
    n = len(s)
    own = band_of(n)
    out = []
    for band in (own, own - 1):
        if band < 0 or (band != own and n * percent > 100 * band_limits(band)[1]):
            continue
        if band not in plans:
            plans[band] = plan(band, percent)
        m = plans[band]
        if not m:
            continue
        block = ((s >> np.uint64(20)) % np.uint64(m)).astype(np.int64)
        content = np.zeros(m, dtype=np.uint64)
        np.add.at(content, block, mix(s ^ np.uint64(0x632BE59BD9B4E019 + band)))
        key = mix(content + np.arange(m, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(band + 1))
        out.append((key & ~np.uint64(255)) | np.uint64(band))
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, dtype=np.int64)


def point(s: np.ndarray, groups: int) -> np.ndarray:
    return np.bincount((mix(s) % np.uint64(groups)).astype(np.int64), minlength=groups)


def fine_groups(n: int) -> int:
    return 1 << min(20, max(5, (n - 1).bit_length()))


def needed(a: np.ndarray | int, b: np.ndarray | int, percent: int):
    """Least overlap of sets of a and b elements within the threshold."""
    return -(-(a + b) * percent // (100 + percent))


def coarse_point(s: np.ndarray) -> bytes:
    """Counts of COARSE groups in a byte each; in large sets in units, rounded up."""
    unit = 1 + len(s) // 8192
    return (-(-point(s, COARSE) // unit)).astype(np.uint8).tobytes()


def corners(raw: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Coarse points, none below the true counts."""
    x = np.frombuffer(b"".join(raw), dtype=np.uint8).reshape(-1, COARSE)
    return x * (1 + sizes // 8192).astype(np.int32)[:, None]


def first_met(key: int, left: list, right: list, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Which pairs (left[r], right[c]) share no bucket with a key smaller than ``key``."""

    def below(lists: list, pad: int) -> np.ndarray:
        wide = max(1, max(map(len, lists)))
        out = np.full((len(lists), wide), pad, dtype=np.int64)
        for i, ks in enumerate(lists):
            ks = np.asarray(ks, dtype=np.int64)
            ks = ks[ks < key]
            out[i, : len(ks)] = ks
        return out

    # Only keys below ``key`` are entered, so the two paddings meet nothing.
    x, y = below(left, key), below(right, (1 << 63) - 1)
    out = np.ones(len(r), dtype=bool)
    step = max(1, 2_000_000 // (x.shape[1] * y.shape[1]))
    for at in range(0, len(r), step):
        part = slice(at, at + step)
        out[part] = ~(x[r[part]][:, :, None] == y[c[part]][:, None, :]).any((1, 2))
    return out


def sets_of(batch: pd.DataFrame, k: int) -> Iterator[np.ndarray]:
    return shingle_sets(list(batch["t"]), k)


def bounded(pairs: pd.DataFrame, percent: int) -> np.ndarray:
    """Which pairs (na, nb, ca, cb: sizes and fine points) may reach the threshold."""
    na, nb = pairs["na"].to_numpy(dtype=np.int64), pairs["nb"].to_numpy(dtype=np.int64)
    want = needed(na, nb, percent)
    ok = np.minimum(na, nb) >= want
    la, lb = pairs["ca"].map(len).to_numpy(), pairs["cb"].map(len).to_numpy()
    for g in sorted(set(zip(la[ok].tolist(), lb[ok].tolist(), strict=True))):
        rows = np.flatnonzero(ok & (la == g[0]) & (lb == g[1]))
        width = min(g)
        for at in range(0, len(rows), max(1, 4_000_000 // max(g))):
            part = rows[at : at + max(1, 4_000_000 // max(g))]
            a = np.frombuffer(b"".join(pairs["ca"].iloc[part]), dtype=np.uint8).reshape(len(part), g[0] // width, width)
            b = np.frombuffer(b"".join(pairs["cb"].iloc[part]), dtype=np.uint8).reshape(len(part), g[1] // width, width)
            low = np.minimum(a.sum(1, dtype=np.uint16), b.sum(1, dtype=np.uint16)).sum(1, dtype=np.int64)
            ok[part] = low >= want[part]
    return ok


class Join:
    """The join's stages over one table of documents."""

    def __init__(self, docs: DataFrame, k: int, percent: int, id_col: str = "doc_id"):
        if not 100 / BAND < percent <= 100:
            raise ValueError("percent must be over 100 / BAND")
        self.spark = docs.sparkSession
        ship_package(self.spark)
        self.k, self.percent = k, percent
        self.docs = docs.select(F.col(id_col).cast("string").alias("i"), F.col("text").alias("t"))
        found = write_shared(self._sizes(), "join-nodes")
        # Two sets with one id: as good as never, and then both take their second hash.
        alike = found.groupBy("node").agg(F.min("spare").alias("lo"), F.max("spare").alias("hi")).where("lo != hi")
        self.shared_ids = frozenset(r["node"] for r in alike.select("node").collect())
        node = F.col("node")
        self.nodes = found.select(
            "doc_id", "n", F.when(node.isin(*self.shared_ids), F.col("spare")).otherwise(node).alias("node") if self.shared_ids else node
        )

    def identify(self):
        """Function from a set to its id."""
        alike = self.shared_ids

        def of(s: np.ndarray) -> int:
            node = fingerprint(s)
            return second_print(s) if node in alike else node

        return of

    def _sizes(self) -> DataFrame:
        """One row a document: id, size, set id and a second hash of the set."""
        k = self.k

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = [(len(s), fingerprint(s), second_print(s)) for s in sets_of(batch, k)]
                made = pd.DataFrame(rows, columns=["n", "node", "spare"])
                made.insert(0, "i", batch["i"].to_numpy())
                yield made

        out = self.docs.mapInPandas(run, "i string, n bigint, node bigint, spare bigint")
        return out.withColumn("doc_id", F.col("i").cast("bigint")).drop("i")

    def _directory(self) -> DataFrame:
        """(key, node) of every set, copies within a batch left out."""
        k, percent, identify = self.k, self.percent, self.identify()

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            plans: dict[int, int] = {}
            for batch in batches:
                seen: set[int] = set()
                keys, nodes = [], []
                for s in sets_of(batch, k):
                    if len(s):
                        node = identify(s)
                        if node not in seen:
                            seen.add(node)
                            found = directory_keys(s, percent, plans)
                            keys.append(found)
                            nodes.append(np.full(len(found), node, dtype=np.int64))
                if keys:
                    yield pd.DataFrame({"key": np.concatenate(keys), "node": np.concatenate(nodes)})

        return self.docs.mapInPandas(run, "key bigint, node bigint")

    def buckets(self) -> DataFrame:
        """(key, node) of the buckets that hold several sets, without the fullest each set leaves out."""
        by_key = Window.partitionBy("key")
        shared = (
            self._directory()
            .select(
                "key", "node", F.min("node").over(by_key).alias("lo"), F.max("node").over(by_key).alias("hi"),
                F.count("*").over(by_key).alias("held"),
            )
            .where(F.col("lo") != F.col("hi"))
            .select("key", "node", "held", F.col("key").bitwiseAND(255).cast("int").alias("band"))
        )
        sizes = self.nodes.where("n > 0").select("node", "n").distinct()
        bands = range(BANDS)
        lookup = lambda f: F.array(*[F.lit(f(b)) for b in bands])[F.col("band")]
        top, m = lookup(lambda b: band_limits(b)[1]), lookup(lambda b: plan(b, self.percent))
        p = F.lit(self.percent)
        partner = F.when(F.col("n") <= top, F.floor(F.col("n") * 100 / p)).otherwise(top)
        apart = F.floor((F.col("n") + partner) * (100 - p) / (100 + p))
        drop = F.floor((m - apart - 1) / 2)  # as left_out()
        fullest = Window.partitionBy("node", "band").orderBy(F.desc("held"), "key")
        left = (
            shared.join(sizes, "node")
            .withColumn("r", F.dense_rank().over(fullest))
            .where(F.col("r") > drop)
            .select("key", "node")
            .distinct()
        )
        # What was left out may have left a set alone in its bucket.
        several = left.select("key", "node", F.min("node").over(by_key).alias("lo"), F.max("node").over(by_key).alias("hi"))
        return several.where(F.col("lo") != F.col("hi")).select("key", "node")

    def members(self, buckets: DataFrame) -> DataFrame:
        """(node, n, fine, coarse, s) of the sets that share a bucket, each read off one document."""
        k, identify = self.k, self.identify()
        wanted = buckets.select("node").distinct()
        rep = self.nodes.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("rep"))
        rep = write_shared(rep, "join-reps")
        wanted = rep.select("node")
        asked = sieve(rep, "rep")
        a, b, c = places(F.col("i").cast("bigint"))
        texts = self.docs.select("i", "t", a.alias("a"), b.alias("b"), c.alias("c"))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows, held = [], 0
                batch = batch[passed(asked.value, [batch[x] for x in "abc"]) | batch["i"].isna().to_numpy()]
                for s in sets_of(batch, k):
                    n = len(s)
                    if n:
                        fine = np.minimum(point(s, fine_groups(n)), 255).astype(np.uint8).tobytes()
                        rows.append((identify(s), n, fine, coarse_point(s), s.tobytes()))
                        held += 8 * n
                    if held > BATCH_BYTES:
                        yield pd.DataFrame(rows, columns=["node", "n", "fine", "coarse", "s"])
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=["node", "n", "fine", "coarse", "s"])

        sets = texts.mapInPandas(run, "node bigint, n bigint, fine binary, coarse binary, s binary")
        # The sieve, and ids that several texts have, bring sets along that nobody asked for.
        return sets.join(wanted, "node", "left_semi").dropDuplicates(["node"])

    def verify(self, pairs: DataFrame, points: DataFrame) -> DataFrame:
        """The pairs (a, b) within the threshold: bound on fine points, then the sets."""
        percent = self.percent
        mine = points.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("fine").alias("ca"))
        other = points.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("fine").alias("cb"))
        joined = pairs.join(mine, "a").join(other, "b")

        def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield batch.loc[bounded(batch, percent), ["a", "b"]]

        left = write_shared(joined.mapInPandas(bound, "a bigint, b bigint"), "join-pairs")
        return write_shared(self._links(left, points), "join-links")

    def _links(self, pairs: DataFrame, points: DataFrame) -> DataFrame:
        """Exact comparison; the sets meet at b, in parts where b has many partners."""
        percent = self.percent
        crowd = pairs.groupBy("b").agg(F.count("*").alias("c")).select("b", F.expr("cast(ceil(c / 1024) as int)").alias("parts"))
        dealt = write_shared(
            pairs.join(crowd, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part")), "join-dealt"
        )
        sent = dealt.select(F.col("a").alias("node"), F.col("b").alias("to"), "part", F.lit(1).alias("role")).unionByName(
            dealt.select(F.col("b").alias("node"), F.col("b").alias("to"), "part", F.lit(0).alias("role")).distinct()
        )
        sets = sent.join(points.select("node", "s"), "node")

        def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            head, own = None, None
            for batch in batches:
                rows = []
                for node, to, role, raw in zip(batch["node"], batch["to"], batch["role"], batch["s"], strict=True):
                    s = np.frombuffer(raw, dtype=np.uint64)
                    if role == 0:
                        head, own = to, s
                    elif head == to:
                        overlap = len(np.intersect1d(own, s, assume_unique=True))
                        if 100 * overlap >= percent * (len(own) + len(s) - overlap):
                            rows.append((node, to))
                yield pd.DataFrame(rows, columns=["a", "b"], dtype="int64")

        met = sets.repartition("to", "part").sortWithinPartitions("to", "part", "role", "node")
        return met.mapInPandas(compare, "a bigint, b bigint").distinct()

    def led(self, buckets: DataFrame) -> DataFrame:
        """(key, node, leader): one leader a bucket, the same for all buckets it is in."""
        return buckets.withColumn("leader", F.min("node").over(Window.partitionBy("key")))

    def apart(self, held: DataFrame, roots: DataFrame) -> DataFrame:
        """(key, node, comp) of the buckets whose members belong to several components."""
        by_key = Window.partitionBy("key")
        comp = F.coalesce("root", "node")
        return (
            held.select("key", "node").join(roots, "node", "left")
            .select("key", "node", comp.alias("comp"))
            .select("key", "node", "comp", F.min("comp").over(by_key).alias("lo"), F.max("comp").over(by_key).alias("hi"))
            .where(F.col("lo") != F.col("hi"))
            .select("key", "node", "comp")
        )

    def between(self, held: DataFrame, points: DataFrame, best: bool) -> DataFrame:
        """Pairs of sets of different components (key, node, comp) that the leaves leave.

        With ``best`` a set is paired with the likeliest partner of a leaf alone.
        """
        percent = self.percent
        order = Window.partitionBy("key").orderBy("comp", "n", "node")
        # A set's smallest keys: a pair is reported in its first common bucket only.
        # (Beyond the first KEYS it may be reported again, never lost.)
        own = held.groupBy("node").agg(F.slice(F.array_sort(F.collect_set("key")), 1, KEYS).alias("keys"))
        leaves = (
            held.join(points.select("node", "n", "coarse").join(own, "node"), "node")
            .withColumn("leaf", F.floor((F.row_number().over(order) - 1) / LEAF).cast("int"))
            .groupBy("key", "leaf")
            .agg(
                F.collect_list(F.struct("node", "comp", "n", "coarse", "keys")).alias("x"),  # at most LEAF
                F.min("n").alias("least"), F.max("n").alias("most"), F.min("comp").alias("c0"), F.max("comp").alias("c1"),
            )
        )
        a, b = leaves.alias("p"), leaves.alias("q")
        near = (
            (F.col("p.key") == F.col("q.key"))
            & (F.col("p.leaf") <= F.col("q.leaf"))
            & (F.col("p.most") * 100 >= F.col("q.least") * percent)
            & (F.col("q.most") * 100 >= F.col("p.least") * percent)
            & ~((F.col("p.c0") == F.col("p.c1")) & (F.col("q.c0") == F.col("q.c1")) & (F.col("p.c0") == F.col("q.c0")))
        )
        joined = a.join(b, near).select(
            F.col("p.key").alias("key"),
            *[F.col(f"{s}.x.{c}").alias(f"{s}_{c}") for s in "pq" for c in ("node", "comp", "n", "coarse", "keys")],
        )

        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                out = []
                for key, pn, pc, ps, pv, pk, qn, qc, qs, qv, qk in batch.itertuples(index=False, name=None):
                    pn, qn, pc, qc = map(np.asarray, (pn, qn, pc, qc))
                    ps, qs = np.asarray(ps, dtype=np.int64), np.asarray(qs, dtype=np.int64)
                    x, y = corners(pv, ps), corners(qv, qs)
                    # The leaves' upper corners first, then point against corner, then points.
                    least = int(needed(int(ps.min()), int(qs.min()), percent))
                    top = y.max(0)
                    if int(np.minimum(x.max(0), top).sum()) < least:
                        continue
                    pairs = []
                    for r in np.flatnonzero(np.minimum(x, top).sum(1) >= needed(ps, int(qs.min()), percent)).tolist():
                        ok = pc[r] != qc
                        if ok.any():
                            spare = np.minimum(x[r], y).sum(1) - needed(ps[r], qs, percent)
                            ok &= spare >= 0
                            if best and ok.any():
                                ok = np.arange(len(ok)) == np.argmax(np.where(ok, spare, -1))
                            pairs.append(np.stack([np.full(int(ok.sum()), r), np.flatnonzero(ok)]))
                    if pairs:
                        r, c = np.concatenate(pairs, 1)
                        fresh = first_met(key, pk, qk, r, c)
                        a, b = pn[r[fresh]], qn[c[fresh]]
                        out.append(np.stack([np.minimum(a, b), np.maximum(a, b)]))
                if out:
                    yield pd.DataFrame(np.unique(np.concatenate(out, 1), axis=1).T, columns=["a", "b"])

        return joined.mapInPandas(search, "a bigint, b bigint").distinct()

    def labels(self) -> DataFrame:
        """(node, root) of the sets that link with another.

        A bucket's members meet its leader; then, where they still belong to several
        components, each its likeliest partners; then all that is still apart is paired.
        """
        led = write_shared(self.led(self.buckets()), "join-buckets")
        points = write_shared(self.members(led), "join-members")
        first = led.where("node != leader").select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
        links = self.verify(first.distinct(), points)
        roots = components(links)
        # A leader has met every member of its bucket.
        held = led.where("node != leader")
        for best in (True, False):
            held = write_shared(self.apart(held, roots), "join-held")
            if held.isEmpty():
                break
            more = self.verify(self.between(held, points, best), points)
            if not more.isEmpty():
                links = links.unionByName(more)
                roots = components(links)
        return roots

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id of every document."""
        roots = self.labels()
        classes = self.nodes.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("rep"))
        joined = classes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "rep")
        named = joined.groupBy("root").agg(F.min("rep").alias("component_id"))
        of_node = joined.join(named, "root").select("node", "component_id")
        return self.nodes.select("doc_id", "n", "node").join(of_node, "node", "left").select(
            "doc_id",
            F.col("n").alias("n_shingles"),
            F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        )


def join(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id of every document; see the module's docstring."""
    return Join(docs, k, percent, id_col).result()


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component (the smallest id), all columns kept.

    Rows with a null id cannot be named and stay; of rows with one id and one text
    one stays.  Columns of any name are handed through.
    """
    found = write_shared(join(docs, k, percent), "join-result")
    own, whole = unused(docs, "id"), unused(docs, "row")
    gone = found.where("doc_id IS NOT NULL AND component_id != doc_id").select(F.col("doc_id").alias(own)).distinct()
    gone = write_shared(gone, "join-gone")
    listed = among(sieve(gone, own), F.col("doc_id"))
    kept = docs.where(listed).join(gone, F.col("doc_id") == F.col(own), "left_anti").unionByName(docs.where(~listed))
    again = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias(own))
    again = write_shared(again, "join-again")
    if again.isEmpty():
        return kept
    once = kept.join(again, F.col("doc_id") == F.col(own), "left_anti")
    twice = kept.join(again, F.col("doc_id") == F.col(own), "left_semi").select(F.struct("*").alias(whole))
    one = twice.groupBy(f"{whole}.doc_id", f"{whole}.text").agg(F.first(whole).alias(whole)).select(f"{whole}.*")
    return once.unionByName(one)
