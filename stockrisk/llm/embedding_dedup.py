"""Near-duplicate embeddings by product quantisation, with no pair lost.

Distinct vectors are filed in inverted lists of their nearest coarse centroid;
a vector is compared with its own list and with every list that can hold a
neighbour (a bound, not a guess: see ``Index.probes``). The vectors lie in
their own list alone; to the others they go as residual codes, a few bytes
each. There, table lookups give the distance of each vector filed to each
visitor as its codes decode; since the decoding error of every vector is
stored, distances above radius + error are ruled out for certain. Visitors that
are left are joined with their vectors, and the pairs left get their exact
cosine in double precision.

Only vectors with one label are compared. Equal vectors (of one label) are
collapsed first and counted in the links. A list is cut into tiles of bounded
size on both sides, so a hot list is many tasks; tiles return link counts and
one link per vector and local group, never all pairs.

Defined cases: vectors that are NULL, empty, zero or hold NULL or non-finite
components, and rows with NULL label, link with nothing and are kept; vectors
of different lengths link with nothing in common; components of any finite
size are compared in full precision; labels of any type are groups; repeated
rows link with each other; a component's ties go to the smallest vec_id; an
empty table gives no rows; other columns are not read, so their names can't
clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from stockrisk.llm.common import connected_components
from stockrisk.llm.quantize import Index
from stockrisk.llm.unionfind import local_roots
from stockrisk.sources.sinks import pin

COSINE = 0.98
TRAIN_ROWS = 16384  # vectors the index is fitted on; every vector is filed
SUBSPACES = 8
LEAST_LISTS, MOST_LISTS = 8, 2048
FILED_TILE = 1024
QUERY_TILE = 16384
HELD = 1 << 20  # links a task holds before it folds them

_KEY = ["label", "width", "list", "row", "column"]
_PLACED = "label long, width int, home int, asks array<int>, rid long, copies long, codes binary, error double"
_CANDIDATES = "label long, width int, list int, row int, column int, rid long, copies long, crossed boolean, hits binary"
_FOUND = "kind int, a long, b long"


def usable(vector: Column) -> Column:
    """False for vectors that link with nothing."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows of doubles, padded with zeros to the index's width."""
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        out[i, : len(v)] = v
    return out


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows by a power of two each, which rounds nothing: squares of tiny or huge components stay in range, cosines the same."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1, keepdims=True))[1])


def _unit(rows: np.ndarray) -> np.ndarray:
    scaled = _scaled(rows)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def fit_index(vectors: DataFrame, lists: int | None = None, rows: int = TRAIN_ROWS) -> Index | None:
    """Index fitted by the driver on at most ``rows`` vectors, smallest hashes first.

    Vectors meet those of their label alone, so the lists are as many as a
    list of the most frequent label holds vectors.
    """
    many = vectors.groupBy("label").count().agg(F.max("count")).first()[0]
    if not many:
        return None
    lists = lists or min(max(round(many**0.5), LEAST_LISTS), MOST_LISTS)
    sample = vectors.orderBy("ka", "kb").limit(rows).select("vector").toPandas()["vector"]
    width = vectors.agg(F.max("width")).first()[0]
    width = -(-width // SUBSPACES) * SUBSPACES
    return Index.fit(_unit(_matrix(sample, width)), lists, SUBSPACES)


def _place(vectors: DataFrame, index: Index, radius: float) -> DataFrame:
    """The vectors with their list, the lists they ask and their codes. Of two lists, the vector of the lower asks the higher."""
    held = vectors.sparkSession.sparkContext.broadcast(index)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pq = held.value
        for whole in frames:
            for low in range(0, len(whole), 2048):
                frame = whole.iloc[low : low + 2048].reset_index(drop=True)
                rows = _unit(_matrix(frame["vector"], pq.centroids.shape[1]))
                home, reach = pq.probes(rows, radius)
                codes, error = pq.encode(rows, home)
                reach &= np.arange(reach.shape[1])[None, :] >= home[:, None]
                asks = [np.flatnonzero(r).astype(np.int32) for r in reach]
                out = frame.assign(home=home, asks=asks, codes=[c.tobytes() for c in codes], error=error)
                yield out[["label", "width", "home", "asks", "rid", "copies", "codes", "error", "vector"]]

    # Vectors travel as they are stored, in single precision if they came so; tasks compute in double.
    return vectors.mapInPandas(run, f"{_PLACED}, vector {vectors.schema['vector'].dataType.simpleString()}")


def _candidates(filed: pd.DataFrame, visitors: pd.DataFrame, pq: Index, radius: float) -> pd.DataFrame:
    """Visitors that may have a neighbour in a tile, each with a mask of the tile's vectors, by rid."""
    filed = filed.sort_values("rid")
    unit = _unit(_matrix(filed["vector"], pq.centroids.shape[1]))
    own = filed["rid"].to_numpy()
    out = []
    for low in range(0, len(visitors) if len(filed) else 0, 1024):
        some = visitors.iloc[low : low + 1024]
        codes = np.frombuffer(b"".join(map(bytes, some["codes"])), np.uint8).reshape(len(some), -1)
        near = pq.table_distances(unit, some["home"].to_numpy(), codes).T <= (radius + some["error"].to_numpy() + 1e-6)[:, None]
        near &= some["rid"].to_numpy()[:, None] != own[None, :]
        left = near.any(1)
        hits = [m.tobytes() for m in np.packbits(near[left], axis=1)]
        out.append(some[left].assign(hits=hits, crossed=(some["home"] != some["list"])[left]))
    names = [*_KEY, "rid", "copies", "crossed", "hits"]
    return pd.concat(out)[names] if out else pd.DataFrame({n: [] for n in names})


def _rerank(filed: pd.DataFrame, asking: pd.DataFrame, width: int, cosine: float) -> pd.DataFrame:
    """Links of one tile: (0, vector, linked rows) and (1, vector, vector of its local group)."""
    if filed.empty or asking.empty:
        return pd.DataFrame({"kind": [], "a": [], "b": []})
    filed = filed.sort_values("rid")
    base = _scaled(_matrix(filed["vector"], width))
    base_norm = np.linalg.norm(base, axis=1)
    names, place = np.unique(np.concatenate([asking["rid"], filed["rid"]]), return_inverse=True)
    asked, held = place[: len(asking)], place[len(asking) :]
    copies, held_copies = asking["copies"].to_numpy(), filed["copies"].to_numpy()
    crossed = asking["crossed"].to_numpy(bool)
    links = np.zeros(len(names), np.int64)
    left, right, many = [], [], 0
    for low in range(0, len(asking), 128):
        some = asking.iloc[low : low + 128]
        query = _scaled(_matrix(some["vector"], width))
        hits = np.frombuffer(b"".join(map(bytes, some["hits"])), np.uint8).reshape(len(some), -1)
        q, f = np.nonzero(np.unpackbits(hits, axis=1)[:, : len(filed)])
        dots = np.einsum("ij,ij->i", query[q], base[f])
        linked = dots / (np.linalg.norm(query, axis=1)[q] * base_norm[f]) >= cosine
        q, f = low + q[linked], f[linked]
        np.add.at(links, asked[q], held_copies[f])
        # Two vectors of one list both ask; of two lists, only one does, and counts for both.
        np.add.at(links, held[f[crossed[q]]], copies[q[crossed[q]]])
        left, right, many = [*left, asked[q]], [*right, held[f]], many + len(q)
        if many > HELD:  # a dense tile: keep one link for each vector
            root = local_roots(len(names), np.concatenate(left), np.concatenate(right))
            own = np.flatnonzero(root != np.arange(len(root)))
            left, right, many = [own], [root[own]], len(own)
    root = local_roots(len(names), np.concatenate(left), np.concatenate(right))
    own, counted = np.flatnonzero(root != np.arange(len(root))), np.flatnonzero(links)
    counts = pd.DataFrame({"kind": 0, "a": names[counted], "b": links[counted]})
    edges = pd.DataFrame({"kind": 1, "a": names[own], "b": names[root[own]]})
    return pd.concat([counts, edges]).astype("int64")


def find_links(
    vectors: DataFrame, index: Index, cosine: float = COSINE, filed_tile: int = FILED_TILE, query_tile: int = QUERY_TILE
) -> DataFrame:
    """Link counts and local links of distinct vectors (rid, label, width, vector, copies): kind, a, b."""
    radius = float(np.sqrt(2 - 2 * cosine))
    placed = pin(_place(vectors, index, radius), "placed")
    key = _KEY[:3]
    visits = placed.select("label", "width", F.explode("asks").alias("list"), "home", "rid", "copies", "codes", "error")
    sizes = visits.groupBy(*key).agg(
        F.ceil(F.sum((F.col("home") == F.col("list")).cast("long")) / filed_tile).cast("int").alias("rows"),
        F.ceil(F.count(F.lit(1)) / query_tile).cast("int").alias("columns"),
    )
    # Lists nothing is filed in need no comparison.
    grids = pin(sizes.where("rows > 0").select(*[F.col(k).alias(f"_{k}") for k in key], "rows", "columns"), "grids")
    same = [F.col(k) == F.col(f"_{k}") for k in key]
    mine = F.xxhash64("rid")
    row, column = F.pmod(mine, "rows").cast("int").alias("row"), F.pmod(mine, "columns").cast("int").alias("column")
    # The two sides of a tile come of one table: columns of their own for this one.
    apart = placed.select(*[F.col(c).alias("list" if c == "home" else c) for c in ("label", "width", "home", "rid", "copies", "vector")])
    filed = apart.join(grids, same).select(
        *key, row, F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"), "rid", "copies", "vector"
    )
    visitors = visits.join(grids, same).select(
        *key, F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"), column, "home", "rid", "copies", "codes", "error"
    )
    held = vectors.sparkSession.sparkContext.broadcast(index)
    kept = pin(
        filed.select(*_KEY, "rid", "vector")
        .groupBy(*_KEY)
        .cogroup(visitors.groupBy(*_KEY))
        .applyInPandas(lambda own, others: _candidates(own, others, held.value, radius), _CANDIDATES),
        "candidates",
    )
    asking = kept.join(placed.select(F.col("rid").alias("_rid"), "vector"), F.col("rid") == F.col("_rid")).drop("_rid")
    width = index.centroids.shape[1]
    return filed.groupBy(*_KEY).cogroup(asking.groupBy(*_KEY)).applyInPandas(lambda own, others: _rerank(own, others, width, cosine), _FOUND)


def near_dedup(
    embeddings: DataFrame,
    cosine: float = COSINE,
    lists: int | None = None,
    filed_tile: int = FILED_TILE,
    query_tile: int = QUERY_TILE,
) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of (vec_id, embedding, label)."""
    # A label is its own number where it is one, its hash otherwise.
    group = F.col("label").cast("long") if isinstance(embeddings.schema["label"].dataType, IntegralType) else F.xxhash64("label")
    # Copies are told by 128 bits of hash; the vectors move once, their ids narrow.
    named = embeddings.select(
        "vec_id",
        group.alias("group"),
        "embedding",
        (usable(F.col("embedding")) & F.col("label").isNotNull()).alias("linked"),
        F.xxhash64("label", "embedding").alias("ka"),
        F.xxhash64("embedding", "label", F.lit(1)).alias("kb"),
    )
    vectors = pin(
        named.where("linked")
        .groupBy("ka", "kb")
        .agg(
            F.first("group").alias("label"),
            F.first("embedding").alias("vector"),
            F.count(F.lit(1)).alias("copies"),
            F.min("vec_id").alias("first"),
        )
        .withColumn("width", F.size("vector"))
        .withColumn("rid", F.monotonically_increasing_id()),
        "vectors",
    )
    index = fit_index(vectors, lists)
    ids = named.select("vec_id", "linked", "ka", "kb")
    if index is None:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = pin(find_links(vectors.select("rid", "label", "width", "vector", "copies"), index, cosine, filed_tile, query_tile), "links")
    counts = found.where("kind = 0").groupBy(F.col("a").alias("_a")).agg(F.sum("b").alias("links"))
    near = connected_components(found.where("kind = 1"), "a", "b")
    classed = (
        vectors.select("ka", "kb", "rid", "copies", "first")
        .join(counts, F.col("rid") == F.col("_a"), "left")
        .join(near, F.col("rid") == F.col("node"), "left")
        .select("ka", "kb", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "rid").alias("class"))
    )
    smallest = classed.groupBy("class").agg(F.min("first").alias("smallest"))
    of_vector = classed.join(smallest, "class").select(F.col("ka").alias("_ka"), F.col("kb").alias("_kb"), "n", "smallest")
    joined = ids.join(of_vector, F.col("linked") & (F.col("ka") == F.col("_ka")) & (F.col("kb") == F.col("_kb")), "left")
    component = F.coalesce("smallest", "vec_id")
    return joined.select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
