"""Main text of pages by a site style tree.

The DOMs of all pages of a host are merged into one tree: a node is a path of
element names, and holds the presentation styles (sequences of child
elements) and the contents (texts of its blocks) its pages have there. Its
importance is the entropy of both over the pages, presentation
|sum p log_m p| and content 1 - mean entropy of a text's spread, summed with
the weights 0.1 and 0.9 and lowered by the share of link text: what a template
repeats has none, what each page writes anew has all of it. Branches of low
importance are removed from every page.

What a page says itself is a prior. A branch taken for boilerplate (nav, aside,
footer, a role, or words of its class and id, see ``dom``) has importance 0:
rotating menus and adverts differ from page to page and would pass for content.
Where a page has an article or main element, nothing outside it is main text,
and inside it takes more to be a template: a node below ``LEAST_IN_MAIN``, or a
text whose own importance at its node, 1 - log_m n, is below it and that stands
on half of the m pages or more, m being ``MIN_MAIN_PAGES`` at least. So a share
line that stands everywhere goes even where it is one paragraph of many. Links
are no sign of a template there. A page that would lose its whole article
keeps it.

A node on fewer than ``MIN_PAGES`` distinct pages tells nothing about itself
(generated class names give each page nodes of its own). Importance is
propagated over the tree for it: a branch has the mean importance of all it
holds, by code points, such nodes counting as content; and such a node is worth
no more than the branch of the nearest node above it that enough pages have. So
a generated item goes with the menu that holds it, and a page's own text under
generated names stays, as it makes most of the branch it stands in.

Hosts with fewer than ``MIN_PAGES`` distinct pages have no template to learn;
their unnamed branches lose importance by link text alone.

Defined cases: NULL or empty html gives the empty text; a NULL url is a host
of its own; repeated pages, and pages with the same article, count once for
the tree, and each gets its text; long or broken pages are read in time linear
in their length; an empty table gives no rows; other columns are not read, so
their names can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockrisk.llm.dom import read_blocks
from stockrisk.sources.sinks import pin

MIN_PAGES = 3
MIN_MAIN_PAGES = 5
LEAST_IMPORTANCE = 0.3
LEAST_IN_MAIN = 0.1
CONTENT_WEIGHT = 0.9
PRESENTATION, CONTENT, PAGE = 0, 1, 2

_READ = (
    "page_id string, url string, host string, page_key long, copy_key long, "
    "blocks array<struct<path:long,text:string>>, main boolean, "
    "nodes array<struct<path:long,kind:tinyint,value:long,weight:int,linked:int>>"
)


def host_of(url: Column) -> Column:
    """Lower-case host name of a url, without user and port; empty for NULL."""
    authority = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(authority)


def _hash(value: str) -> int:
    return xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass")) - 2**63


def read_page(html: str) -> tuple[list[dict], bool, list[dict]]:
    """Blocks a page may keep, whether an article or main element holds them, and its nodes for the tree."""
    blocks, styles, around = read_blocks(html)
    main = any(b.zone == 1 for b in blocks)
    own = [b for b in blocks if b.zone == (1 if main else 2)]
    nodes = {}
    for path, children in styles.items():
        at = path - 2**63
        nodes[at, PAGE, around[path] - 2**63] = [1, 0]
        nodes[at, PRESENTATION, _hash(" ".join(children))] = [1, 0]
    for b in blocks:
        at = b.path - 2**63
        seen = nodes.setdefault((at, CONTENT, _hash(b.text)), [0, 0])
        seen[0] += len(b.text)
        seen[1] += b.linked
    kept = [{"path": b.path - 2**63, "text": b.text} for b in own]
    listed = [{"path": p, "kind": k, "value": v, "weight": w, "linked": a} for (p, k, v), (w, a) in nodes.items()]
    return kept, main, listed


def read_pages(pages: DataFrame) -> DataFrame:
    """Pages as blocks and nodes, written to the shared folder."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in frames:
            for low in range(0, len(whole), 256):
                frame = whole.iloc[low : low + 256]
                read = [read_page(h or "") for h in frame["html"]]
                out = frame[["page_id", "url", "host", "page_key"]].copy()
                out["blocks"], out["main"], out["nodes"] = ([r[i] for r in read] for i in range(3))
                # Pages with one article are copies, whatever stands around it.
                out["copy_key"] = [_hash("\n".join(b["text"] for b in r[0])) if r[1] else k for r, k in zip(read, frame["page_key"], strict=True)]
                yield out

    # The id travels as text: pandas has no long column with NULLs.
    source = pages.select(
        F.col("page_id").cast("string").alias("page_id"), "url", host_of(F.col("url")).alias("host"), F.xxhash64("html").alias("page_key"), "html"
    )
    kind = pages.schema["page_id"].dataType
    return pin(source.mapInPandas(run, _READ).withColumn("page_id", F.col("page_id").cast(kind)), "style_tree")


def weighed(read: DataFrame, *columns: Column | str) -> DataFrame:
    """host, share and ``columns`` of every page: each of c copies counts as 1 / c."""
    # Only keys that do repeat are joined.
    repeated = pin(
        read.groupBy("host", "copy_key").agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1"), "repeated_pages"
    ).withColumnsRenamed({"host": "_host", "copy_key": "_key"})
    own = read.select("host", "copy_key", *columns).join(
        repeated, (F.col("host") == F.col("_host")) & (F.col("copy_key") == F.col("_key")), "left"
    )
    return own.withColumn("share", 1 / F.coalesce("_copies", F.lit(1))).drop("copy_key", "_host", "_key", "_copies")


def node_importance(read: DataFrame, content_weight: float = CONTENT_WEIGHT, min_pages: int = MIN_PAGES) -> DataFrame:
    """The merged trees: host, path, above (the path around it), pages, importance of every node.

    ``learned`` is the importance without links, ``common`` the pages of the
    node's most repeated text, ``weight`` the code points it holds itself.
    """
    nodes = weighed(read, "nodes").select("host", "share", F.explode("nodes").alias("n")).select("host", "share", "n.*")
    spread = nodes.groupBy("host", "path", "kind", "value").agg(
        F.round(F.sum("share")).alias("n"),
        F.sum(F.col("weight") * F.col("share")).alias("weight"),
        F.sum(F.col("linked") * F.col("share")).alias("linked"),
    )
    node = spread.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind") == PAGE, F.col("n"))).alias("pages"),
        F.max(F.when(F.col("kind") == PAGE, F.col("value"))).alias("above"),
        F.sum(F.when(F.col("kind") == PRESENTATION, F.col("n") * F.log("n"))).alias("styled"),
        F.sum(F.when(F.col("kind") == PRESENTATION, F.col("n"))).alias("styles"),
        F.sum(F.when(F.col("kind") == CONTENT, F.col("weight"))).alias("weight"),
        F.sum(F.when(F.col("kind") == CONTENT, F.col("weight") * F.log("n"))).alias("repeated"),
        F.sum(F.when(F.col("kind") == CONTENT, F.col("linked"))).alias("linked"),
        F.max(F.when(F.col("kind") == CONTENT, F.col("n"))).alias("common"),
    )
    scale = F.nullif(F.log("pages"), F.lit(0.0))
    # sum p log(1/p) over styles with p = n / styles
    entropy = F.coalesce((F.log("styles") - F.col("styled") / F.col("styles")) / scale, F.lit(0.0))
    content = F.coalesce(1 - F.col("repeated") / F.col("weight") / scale, F.lit(1.0))
    links = F.coalesce(F.col("linked") / F.col("weight"), F.lit(0.0))
    learned = (1 - content_weight) * F.least(entropy, F.lit(1.0)) + content_weight * content
    known = F.when(F.col("pages") >= min_pages, learned).otherwise(1.0)
    return node.select(
        "host", "path", "above", "pages", (known * (1 - links)).alias("importance"), learned.alias("learned"), "common",
        F.coalesce("weight", F.lit(0.0)).alias("weight"),
    )


def branch_importance(tree: DataFrame) -> DataFrame:
    """host, path, branch: mean importance of all that a node's branch holds, by code points; 1 for a branch without text.

    Sums over the branch by doubling: in each round a node gets the sums of
    those that stand as far below it as all rounds before have reached, so a
    tree of depth d takes log2(d) rounds of one join and one grouped sum.
    """
    up = F.when(F.col("above") != F.col("path"), F.col("above"))
    sums = pin(tree.select("host", "path", up.alias("up"), F.col("weight").alias("total"), (F.col("weight") * F.col("importance")).alias("gained")), "branches")
    nowhere, nothing = F.lit(None).cast("long"), F.lit(0.0)
    while not (moving := sums.where("up IS NOT NULL")).isEmpty():
        target = sums.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("up").alias("_up"))
        hops = moving.join(target, (F.col("host") == F.col("_host")) & (F.col("up") == F.col("_path")))
        parts = (
            sums.select("host", "path", nowhere.alias("up"), "total", "gained")
            .union(moving.select("host", "up", nowhere, "total", "gained"))
            .union(hops.select("host", "path", "_up", nothing, nothing))
        )
        grouped = parts.groupBy("host", "path").agg(F.max("up").alias("up"), F.sum("total").alias("total"), F.sum("gained").alias("gained"))
        sums = pin(grouped, "branches")
    mean = F.when(F.col("total") > 0, F.col("gained") / F.col("total")).otherwise(1.0)
    return sums.select("host", "path", F.round(mean, 9).alias("branch"))


def enclosing_importance(tree: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, path, around, around_pages of every node on fewer than ``min_pages`` pages that stands in one on more.

    ``around`` is the branch importance of the nearest such node above. The
    way up is halved in each round.
    """
    rare = pin(tree.where(F.col("pages") < min_pages).select("host", "path", F.col("above").alias("up")), "rare_nodes")
    while True:
        target = rare.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.col("up").alias("_up"))
        hop = rare.join(target, (F.col("host") == F.col("_host")) & (F.col("up") == F.col("_path")), "left")
        # The page's own node stands above itself, so where it is rare itself the way ends there.
        moved = pin(hop.select("host", "path", F.coalesce("_up", "up").alias("up"), (F.col("_up") != F.col("up")).alias("on")), "rare_nodes")
        rare = moved.drop("on")
        if moved.where("on").isEmpty():
            break
    known = tree.where(F.col("pages") >= min_pages).select("host", F.col("path").alias("up"), F.col("pages").alias("around_pages"))
    branches = branch_importance(tree).withColumnRenamed("path", "up")
    return rare.join(known, ["host", "up"]).join(branches, ["host", "up"]).select("host", "path", F.col("branch").alias("around"), "around_pages")


def _repeats(n: Column, pages: Column) -> Column:
    """Whether a text on n of a node's pages is a template in an article."""
    return (n * 2 >= pages) & (1 - F.log(n) / F.log(pages) < LEAST_IN_MAIN)


def removed_blocks(read: DataFrame, least: float, content_weight: float, min_pages: int) -> DataFrame:
    """_host, _key (of the page), _removed: the places of the blocks a page loses, where it loses any."""
    enough = F.col("pages") >= max(min_pages, MIN_MAIN_PAGES)
    tree = pin(node_importance(read, content_weight, min_pages), "tree")
    around = enclosing_importance(tree, min_pages).withColumnsRenamed({"host": "_host", "path": "_path"})
    in_template = (F.col("around") < LEAST_IN_MAIN) & (F.col("around_pages") >= max(min_pages, MIN_MAIN_PAGES))
    judged = (
        tree.join(around, (F.col("host") == F.col("_host")) & (F.col("path") == F.col("_path")), "left")
        .select(
            "host", "path", "pages", (F.least("importance", "around") < least).alias("low"),
            ((enough & (F.col("learned") < LEAST_IN_MAIN)) | F.coalesce(in_template, F.lit(False))).alias("low_in_main"),
            F.coalesce(enough & _repeats(F.col("common"), F.col("pages")), F.lit(False)).alias("mixed"),
        )
        .where("low or low_in_main or mixed")
    )
    judged = pin(judged, "judged")
    placed = F.transform("blocks", lambda b, i: F.struct(b["path"].alias("path"), F.xxhash64(b["text"]).alias("value"), i.alias("at")))
    texts = F.array_distinct(F.transform("blocks", lambda b: F.struct(b["path"].alias("path"), F.xxhash64(b["text"]).alias("value"))))
    common = (
        weighed(read.where("main"), texts.alias("texts"))
        .select("host", "share", F.inline("texts"))
        .join(judged.where("mixed and not low_in_main").select("host", "path", "pages"), ["host", "path"])
        .groupBy("host", "path", "value")
        .agg(F.round(F.sum("share")).alias("n"), F.max("pages").alias("pages"))
        .where(_repeats(F.col("n"), F.col("pages")))
        .select("host", "path", "value")
    )
    # A row a block, without its text; hot nodes are split by the skew join, as the judged side has one row of each.
    blocks = read.select("host", "page_key", "main", F.inline(placed))
    by_node = blocks.join(judged, ["host", "path"]).where((F.col("main") & F.col("low_in_main")) | (~F.col("main") & F.col("low")))
    by_text = blocks.where("main").join(pin(common, "common_texts"), ["host", "path", "value"])
    lost = by_node.select("host", "page_key", "at").unionByName(by_text.select("host", "page_key", "at"))
    return lost.groupBy(F.col("host").alias("_host"), F.col("page_key").alias("_key")).agg(F.collect_set("at").alias("_removed"))


def main_text(
    pages: DataFrame, least: float = LEAST_IMPORTANCE, content_weight: float = CONTENT_WEIGHT, min_pages: int = MIN_PAGES
) -> DataFrame:
    """page_id, url, text (blocks in page order, one per line) of every page."""
    read = read_pages(pages)
    removed = pin(removed_blocks(read, least, content_weight, min_pages), "removed")
    joined = read.drop("nodes").join(removed, (F.col("host") == F.col("_host")) & (F.col("page_key") == F.col("_key")), "left")
    left = F.array_except(F.sequence(F.lit(0), F.size("blocks") - 1), "_removed")
    # Copies of one article that differ in a word are no template either.
    whole = F.col("_removed").isNull() | (F.col("main") & (F.size(left) == 0))
    kept = F.when(whole, F.col("blocks.text")).otherwise(F.transform(left, lambda i: F.get("blocks", i)["text"]))
    return joined.select("page_id", "url", F.array_join(kept, "\n").alias("text"))


def page_report(pages: DataFrame) -> DataFrame:
    """The query's digest: page_id, url, text, n_chars."""
    return main_text(pages).withColumn("n_chars", F.length("text").cast("long"))
