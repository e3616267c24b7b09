"""Documents linked by the Jaccard similarity of their word shingles, by vertical partitioning.

The global order of shingles is that of their 64-bit hashes; it is cut into fragments of equal range. Linked sets differ in
few shingles, so with more fragments than differences at least one fragment is the same in both: sets that agree in a whole
fragment are candidates. Shingles that a sample shows to be very common are left out of fragments (in both sets alike, so
no link is lost), lest passages of many documents make candidates. There are more fragments than that takes, so linked sets agree
in several: the agreements of a set are counted over all fragments, and sets with too few of them are no candidates.
Candidates form clusters; in each, overlaps are counted fragment by fragment and summed per pair, then compared with the
threshold exactly.

Equal sets are one node from the start. A cluster's sets are first compared with its lead alone. Jaccard distances obey the
triangle inequality, so among sets linked to the lead only those far enough from it can be linked to the others; sets linked
to the lead already need no comparison with each other. What is left of large clusters is dealt out in pairs of blocks; a
task holds two blocks, counts overlaps as products of small matrices and returns a spanning set of the links, never its pairs.
Nothing but loop control passes the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cairngraph.llm.common import by_group, components, over_batches, perhaps_in, stored, texts
from cairngraph.llm.registry import query, table
from cairngraph.llm.text import chunks, mix, runs, signed, words
from cairngraph.session import cut

BLOCK = 400  # sets in a block on average
SAMPLE = 32  # one document in so many is searched for common shingles
COMMON = 4  # a shingle this often in the sample is common
MOST_COMMON = 100_000  # at most so many are left out (800 KB); affects work, never links
COLUMNS = 4096  # shingles of a fragment when overlaps are counted
TAG = 12  # low bits of a signature: class, step and number of agreements that a set needs; the rest identifies the fragment
U = np.uint64


def _sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and shingle of all distinct shingles, sorted by both."""
    w = words(texts, fold=True)
    grams, inside = runs(w, n, salt=3)
    doc, gram = [w.doc[: len(grams)][inside]], [grams[inside]]
    counts = np.diff(w.first)
    for m in range(1, n):  # fewer words: the whole sequence is one shingle
        short = np.flatnonzero(counts == m)
        if len(short):
            whole, _ = runs(w, m, salt=1000 + m)
            doc.append(short)
            gram.append(whole[w.first[short]])
    doc, gram = np.concatenate(doc), np.concatenate(gram)
    order = np.lexsort((gram, doc))
    doc, gram = doc[order], gram[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1]))[: len(doc)]
    return doc[new], gram[new]


def _nodes(doc: np.ndarray, gram: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Set size and set hash of each row; equal sets have equal hashes."""
    size = np.bincount(doc, minlength=n_docs)
    total = np.zeros(n_docs, U)
    if len(doc):
        lead = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
        total[doc[lead]] = np.add.reduceat(mix(gram ^ U(0x5BF03635)), lead)
    return size, signed(mix(total + size.astype(U)))


def _profile(n: int):
    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = batch.column("text")
        for a, b in chunks(texts):
            size, node = _nodes(*_sets(texts.slice(a, b - a), n), b - a)
            rest = {c: batch.column(c).slice(a, b - a) for c in batch.schema.names if c != "text"}
            yield pa.record_batch(rest | {"n_shingles": pa.array(size, pa.int64()), "node": node})

    return over_batches(step)


class Classes:
    """Size classes and their number of fragments, for a threshold of `p` percent."""

    def __init__(self, p: int, largest: int):
        lo, self.lows, self.fragments, self.spare = 1, [], [], []
        while lo <= largest:
            high = max(lo, lo * 5 // 4)
            differ = (high + 100 * high // p) * (100 - p) // (100 + p)  # of two linked sets, the smaller in this class
            spare = 2 + differ // 12 if differ else 0  # linked sets agree in one fragment more than this
            self.lows.append(lo)
            self.spare.append(spare)
            self.fragments.append(differ + 1 + spare)
            lo = high + 1

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, size, "right") - 1


def _counts(n: int):
    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for a, b in chunks(batch.column("text")):
            gram, count = np.unique(_sets(batch.column("text").slice(a, b - a), n)[1], return_counts=True)
            yield pa.record_batch({"gram": signed(gram), "n": count})

    return over_batches(step)


def _fragments(doc, gram, fragments, salt):
    """Each set's non-empty fragments: row, hash, and by row the number of empty ones."""
    fragment = ((gram >> U(32)) * fragments[doc].astype(U)) >> U(32)
    lead = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (fragment[1:] != fragment[:-1]))[: len(doc)])
    if not len(lead):
        return doc, gram, fragments.copy()
    held = np.add.reduceat(mix(gram ^ U(0x2545F491)), lead)
    row = doc[lead]
    sig = mix(held + (fragments[row].astype(U) << U(32)) + fragment[lead] + U(salt))
    return row, sig, fragments - np.bincount(row, minlength=len(fragments))


def _tagged(sig: np.ndarray, group: np.ndarray, step: int, need: np.ndarray) -> np.ndarray:
    return (sig >> U(TAG) << U(TAG)) | ((group % 8) * 512 + step * 128 + need).astype(U)


def _signatures(n: int, p: int, common: np.ndarray):
    """(`sig`, `node`): what two linked sets share as often as the low bits of `sig` say.

    A set signs for the class of its own size and for those of the smaller sets it can link with, by each fragment of
    its uncommon shingles that is not empty. Linked sets agree in more than `spare` fragments, so only sets with more than
    `spare` empty ones could agree in empty ones alone. Those sign by all their shingles too, and if even then more than
    `spare` fragments are empty, by their first shingles (of which linked sets share one).
    """

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, seen = batch.column("text"), np.zeros(0, np.int64)
        for a, b in chunks(texts):
            doc, gram = _sets(texts.slice(a, b - a), n)
            size, node = _nodes(doc, gram, b - a)
            fresh, first = np.unique(node, return_index=True)
            first = first[~np.isin(fresh, seen) & (size[first] > 0)]
            seen = np.union1d(seen, fresh)
            chosen = np.zeros(b - a, bool)
            chosen[first] = True
            keep = chosen[doc]
            doc, gram = doc[keep], gram[keep]
            if not len(doc):
                continue
            rare = ~np.isin(gram, common)
            classes = Classes(p, int(size.max()))
            own = classes.of(size)
            least = classes.of(-(-size * p // 100))
            at = np.arange(len(doc)) - np.searchsorted(doc, np.arange(b - a))[doc]
            in_prefix = at < (size - -(-size * p // 100) + 1)[doc]
            fragments, spare = np.array(classes.fragments), np.array(classes.spare)
            found = []
            for back in range(int((own - least)[chosen].max()) + 1):
                group = np.maximum(own - back, 0)
                open_rows = chosen & (own - back >= least)
                for salt, which in ((0, rare), (1, np.ones(len(doc), bool))):
                    use = open_rows[doc] & which
                    row, sig, empty = _fragments(doc[use], gram[use], fragments[group], salt)
                    # agreements in empty fragments carry no signature; who goes on to the next step may meet few here
                    need = np.clip(spare[group] + 1 - empty, 1, 127)
                    found.append((_tagged(sig, group[row], salt, need[row]), row))
                    open_rows &= empty > spare[group]
                    if not open_rows.any():
                        break
                else:
                    use = open_rows[doc] & in_prefix
                    found.append((_tagged(mix(gram[use] ^ U(0x1F83D9AB)), group[doc[use]], 2, np.ones(int(use.sum()), np.int64)), doc[use]))
            sigs, rows = np.concatenate([s for s, _ in found]), np.concatenate([r for _, r in found])
            yield pa.record_batch({"sig": signed(sigs), "node": node[rows]})

    return over_batches(step)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of signatures in order, those that several sets have; a key's rows pass one by one and are never held."""
    key, one, several = None, None, False  # the last key, its first row, and whether two sets had it
    for batch in batches:
        if not batch.num_rows:
            continue
        sig, node = batch.column("sig").to_numpy(), batch.column("node").to_numpy()
        keys = sig >> TAG
        new = np.append(True, keys[1:] != keys[:-1])
        lead = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        first = node[lead]
        differ = np.zeros(len(lead), bool)
        if keys[0] == key:
            first[0], differ[0] = one[1], several
        np.logical_or.at(differ, group, node != first[group])
        out = differ[group]
        sig_out, node_out = sig[out], node[out]
        if keys[0] == key and differ[0] and not several:  # now the first row counts, too
            sig_out, node_out = np.append(one[0], sig_out), np.append(one[1], node_out)
        if keys[-1] == key and len(lead) == 1:
            several = differ[0]
        else:
            begin = lead[-1]
            key, one, several = keys[-1], (sig[begin], node[begin]), bool(differ[-1])
        if len(sig_out):
            yield pa.record_batch({"node": node_out, "key": sig_out >> TAG, "tag": sig_out & ((1 << TAG) - 1)})


def _blobs(n: int):
    """The sorted shingles of the sets asked for."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts, asked = batch.column("text"), batch.column("node").to_numpy()
        for a, b in chunks(texts):
            doc, gram = _sets(texts.slice(a, b - a), n)
            _, node = _nodes(doc, gram, b - a)
            edge = np.searchsorted(doc, np.arange(b - a + 1))
            right = np.flatnonzero(node == asked[a:b])  # an id may have several texts
            yield pa.record_batch(
                {
                    "cluster": batch.column("cluster").slice(a, b - a).take(pa.array(right)),
                    "node": node[right],
                    "grams": pa.array([gram[edge[r] : edge[r + 1]].tobytes() for r in right.tolist()], pa.binary()),
                }
            )

    return over_batches(step)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Common shingles of every left with every right set: partial counts per fragment of the order, summed."""
    found = np.zeros((len(left), len(right)), np.int32)
    a, b = np.concatenate(left), np.concatenate(right)
    ra = np.repeat(np.arange(len(left)), [len(x) for x in left])
    rb = np.repeat(np.arange(len(right)), [len(x) for x in right])
    known = np.intersect1d(a, b)
    for at in range(0, len(known), COLUMNS):
        fragment = known[at : at + COLUMNS]
        sides = []
        for values, rows, count in ((a, ra, len(left)), (b, rb, len(right))):
            inside = np.flatnonzero((values >= fragment[0]) & (values <= fragment[-1]))
            column = np.searchsorted(fragment, values[inside])
            hit = fragment[column] == values[inside]
            matrix = np.zeros((count, len(fragment)), np.float32)
            matrix[rows[inside][hit], column[hit]] = 1
            sides.append(matrix)
        found += (sides[0] @ sides[1].T).astype(np.int32)
    return found


def _against_lead(p: int):
    """Each set's distance from its cluster's lead, and whether they are linked."""

    def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        distance, linked = [], []
        for own, lead in zip(batch.column("grams").to_pylist(), batch.column("lead").to_pylist(), strict=True):
            own, lead = np.frombuffer(own, U), np.frombuffer(lead, U)
            common = len(np.intersect1d(own, lead, assume_unique=True))
            union = len(own) + len(lead) - common
            distance.append(1 - common / union)
            linked.append(100 * common >= p * union)
        yield pa.record_batch({"cluster": batch.column("cluster"), "node": batch.column("node"), "distance": pa.array(distance, pa.float64()), "linked": pa.array(linked, pa.bool_())})

    return over_batches(step)


def _links(p: int):
    """Of two blocks: each connected group's members linked with its least one."""

    def step(group: pa.Table) -> Iterator[pa.RecordBatch]:
        node = group.column("node").to_numpy()
        node, first = np.unique(node, return_index=True)
        grams = group.column("grams").to_pylist()
        block = group.column("block").to_numpy()[first]
        sets = [np.frombuffer(grams[i], U) for i in first.tolist()]
        sides = [np.flatnonzero(block == x) for x in np.unique(block)]
        left, right = sides[0], sides[-1]
        if len(node) < 2:
            return
        common = overlaps([sets[i] for i in left], [sets[i] for i in right])
        size = np.array([len(s) for s in sets])
        union = size[left][:, None] + size[right][None, :] - common
        i, j = np.nonzero(100 * common >= p * union)
        root = np.arange(len(node))
        x, y = left[i], right[j]
        while True:  # least reachable index, by halving paths
            low = np.minimum(root[x], root[y])
            before = root.copy()
            np.minimum.at(root, x, low)
            np.minimum.at(root, y, low)
            root = root[root]
            if (root == before).all():
                break
        linked = np.flatnonzero(root != np.arange(len(node)))
        if len(linked):
            yield pa.record_batch({"a": node[linked], "b": node[root[linked]]})

    return step


def jaccard_components(docs: DataFrame, n: int = 4, percent: int = 85, rows: bool = False) -> DataFrame:
    """`doc_id`, `n_shingles` and `component_id` (least id reachable by links) for every row of `docs`.

    A set holds the distinct shingles of `n` words after lower-casing A-Z; with fewer words, the whole sequence as one. Two
    documents link when 100 * intersection >= `percent` * union. Documents without words (null or empty texts) link with
    nothing. Repeated rows are rows of their own with one component. A row with a null id names no
    component: its `component_id` is that of rows with the same set, or null if no row with an id has it. An empty table gives no row; other
    columns are ignored.

    With `rows`, also `text_key` (xxhash64 of the text) and `survives`: in each component the rows of one pair of id and
    `text_key`, the least; of rows without words or without an id, all.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must lie between 50 and 100")
    plain = docs.select(*texts(docs))
    key = ["text_key"] if rows else []
    keyed = plain.withColumn("text_key", F.xxhash64("text")) if rows else plain
    profile = cut(keyed.mapInArrow(_profile(n), f"doc_id long, {'text_key long, ' if rows else ''}n_shingles long, node long"))
    sample = plain.filter((F.crc32(F.col("doc_id").cast("string").cast("binary")) % SAMPLE == 0) & F.col("text").isNotNull())
    counts = sample.mapInArrow(_counts(n), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    common = counts.filter(F.col("n") >= COMMON).orderBy(F.desc("n"), "gram").limit(MOST_COMMON).toArrow()["gram"]
    common = np.sort(common.to_numpy()).view(U)
    signatures = plain.filter("text is not null").mapInArrow(_signatures(n, percent, common), "sig long, node long")
    ordered = signatures.repartition(F.shiftright("sig", TAG)).sortWithinPartitions("sig")
    shared = ordered.mapInArrow(_shared, "node long, key long, tag long")
    # sets that agree with others too seldom go
    often = F.count(F.lit(1)).over(Window.partitionBy("node", "tag"))
    held = shared.withColumn("often", often).filter(F.col("often") >= F.col("tag").bitwiseAND(127)).select("node", "key")
    held = cut(held)
    leads = held.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).filter("lead <> last")
    held = held.join(leads.select("key", "lead"), "key")
    clusters = cut(components(held.filter("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b"))))
    holder = profile.filter("doc_id is not null").groupBy("node").agg(F.min("doc_id").alias("holder"))
    asked = clusters.join(holder, F.col("id") == F.col("node")).select("holder", "node", F.col("component").alias("cluster"))
    asked = cut(asked)
    # these sides grow with the table, so they are never broadcast
    wanted = perhaps_in(plain, "doc_id", asked.select("holder")).filter("perhaps")
    sets = stored(
        wanted.join(asked.hint("merge"), wanted["doc_id"] == asked["holder"])
        .select("cluster", "node", "text")
        .mapInArrow(_blobs(n), "cluster long, node long, grams binary")
    )
    leads = sets.filter("node = cluster").groupBy("cluster").agg(F.first("grams").alias("lead"))
    told = cut(sets.join(leads.hint("merge"), "cluster").mapInArrow(_against_lead(percent), "cluster long, node long, distance double, linked boolean").distinct())
    # of the sets linked to the lead, only those at some distance from it can be linked to one that is not
    nearest = told.filter("not linked").groupBy("cluster").agg(F.min("distance").alias("nearest"))
    kept = told.join(nearest, "cluster").filter(~F.col("linked") | (F.col("distance") >= F.col("nearest") - (1 - percent / 100) - 1e-9))
    sizes = kept.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    kept = kept.join(sizes, "cluster").select("cluster", "node", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks"))
    # a block meets itself and every other block of its cluster once
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = sets.join(kept.hint("merge"), ["cluster", "node"]).withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "cluster", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "node", "grams"
    )
    keys = ["cluster", "low", "high"]
    linked = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(by_group(keys, _links(percent)), "a long, b long")
    linked = linked.unionByName(told.filter("linked and node <> cluster").select(F.col("node").alias("a"), F.col("cluster").alias("b")))
    roots = components(linked)
    named = profile.join(roots, profile["node"] == roots["id"], "left").select(
        "doc_id", *key, "n_shingles", F.coalesce("component", "node").alias("root")
    )
    named = cut(named)
    held = named.filter("n_shingles > 0 and doc_id is not null" if rows else "n_shingles > 0")
    least = held.groupBy("root").agg(*([F.min(F.struct("doc_id", "text_key")).alias("first")] if rows else [F.min("doc_id").alias("least")]))
    if rows:
        least = least.select("root", F.col("first.doc_id").alias("least"), F.col("first.text_key").alias("least_key"))
        same = (F.col("doc_id") == F.col("least")) & (F.col("text_key") == F.col("least_key"))
        survives = [(F.col("doc_id").isNull() | (F.col("n_shingles") == 0) | same).alias("survives")]
    return named.join(least, "root", "left").select(
        "doc_id",
        *key,
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        *(survives if rows else []),
    )


def drop_near_copies(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """`docs` with one document left of each group linked by the similarity of `n`-word shingles: the one of least id.

    A row leaves by its own text, whatever other rows of its id hold. Of rows that share an id and a text one stays, the
    least by its other columns; rows without an id stay, as do null and empty texts of different ids. An empty table gives no row.
    """
    found = stored(jaccard_components(docs.select("doc_id", "text"), n, percent, rows=True).select("doc_id", "text_key", "survives"))
    losers = found.filter("not survives").select(F.col("doc_id").alias("l"), F.col("text_key").alias("t")).distinct()
    twins = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("doc_id")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.select("row", F.col("row.doc_id").cast("long").alias("d"), F.col("row.text").cast("string").alias("x"))
    flagged = perhaps_in(rows, "d", losers.select("l").unionByName(twins.select(F.col("doc_id").alias("l"))))
    touched = flagged.filter("perhaps")
    touched = touched.join(losers.hint("merge"), (touched["d"] == losers["l"]) & (F.xxhash64("x") == losers["t"]), "left_anti")
    order = [F.col("row").getField(c) for c in docs.columns if c not in ("doc_id", "text")]
    same = Window.partitionBy("d", F.sha2(F.coalesce(F.col("x"), F.lit("")).cast("binary"), 256)).orderBy(*(order or [F.lit(1)]))
    touched = touched.withColumn("r", F.row_number().over(same)).filter("r = 1")
    return flagged.filter("not perhaps").select("row").unionByName(touched.select("row")).select("row.*")


ORACLE = r"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
  from documents
), s as (
  select distinct doc_id, gram from (
    select doc_id, case when len(words) < 4 then words else list_slice(words, i, i + 3) end as gram
    from (select doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) as i from w where len(words) > 0)
  )
), n as (select doc_id, count(*) as n from s group by doc_id),
o as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from s a join s b on a.gram = b.gram and a.doc_id <> b.doc_id group by all
), l as (
  select o.a, o.b from o join n x on o.a = x.doc_id join n y on o.b = y.doc_id
  where 100 * o.c >= 85 * (x.n + y.n - o.c)
), r as (
  select doc_id as a, doc_id as b from w
  union
  select r.a, l.b from r join l on r.b = l.a
)
select w.doc_id, coalesce(max(n.n), 0) as n_shingles, min(r.b) as component_id
from w join r on w.doc_id = r.a left join n on w.doc_id = n.doc_id group by w.doc_id
"""


@query("op8_jaccard_join", ORACLE)
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=4, percent=85)
