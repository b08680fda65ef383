"""Lookups and listings over catalog frames: datasets, resources, imports, events."""

from __future__ import annotations

import warnings
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.functions import ancestors, basename, is_dataset_rid, parent
from tidemark.operators.transactions import top_per_key
from tidemark.operators.views import KEY
from tidemark.session import measured_side

# Bounds of a page.
MIN_PAGE = 1
MAX_PAGE = 500
FILE_PAGE = 1000

# The fields a listing can be sorted by, and their columns.
SORT_COLUMNS = {"name": "name", "lastModified": "last_modified", "rid": "rid"}
SORT_FIELDS = {"NAME": "name", "LAST_MODIFIED": "last_modified"}


def identity_lookup(requests: DataFrame, identities: DataFrame) -> DataFrame:
    """Resolve requests(ref) to identities(dataset_path, dataset_rid, ...): by rid if the text is one, else by path.

    ``hits`` tells how many datasets matched; only exactly one is a valid answer, the other rows carry NULLs.
    Both keys are unfolded on the identity side, so that one equi-join serves rids and paths.
    """
    others = [c for c in identities.columns if c not in ("dataset_path", "dataset_rid")]
    keyed = identities.select(
        F.explode(F.array("dataset_rid", "dataset_path")).alias("ref"), "dataset_path", "dataset_rid", *others
    ).where(is_dataset_rid(F.col("ref")) == (F.col("ref") == F.col("dataset_rid")))
    # one row per ref: the payload is only used where the ref is unique
    resolved = keyed.groupBy("ref").agg(
        F.count(F.lit(1)).alias("hits"), *[F.first(c).alias(c) for c in ("dataset_path", "dataset_rid", *others)]
    )
    joined = requests.join(measured_side(resolved, "identities"), "ref", "left").withColumn("hits", F.coalesce("hits", F.lit(0)))
    for name in ("dataset_path", "dataset_rid", *others):
        joined = joined.withColumn(name, F.when(F.col("hits") == 1, F.col(name)))
    return joined


def paths_for_rids(rids: DataFrame, resources: DataFrame) -> DataFrame:
    """Path of each requested rid, NULL where there is none."""
    return rids.join(resources.select("rid", "path"), "rid", "left")


def resources_exist(rids: DataFrame, resources: DataFrame) -> DataFrame:
    known = resources.select("rid", F.lit(True).alias("found"))
    return rids.join(known, "rid", "left").select(*rids.columns, F.coalesce("found", F.lit(False)).alias("exists"))


def dangling_imports(imports: DataFrame, resources: DataFrame) -> DataFrame:
    """Imports whose target rid is no known resource."""
    return imports.join(resources.select("rid"), "rid", "left_anti")


def imports_by_type(imports: DataFrame, import_type: str | None = None) -> DataFrame:
    return imports if import_type is None else imports.where(F.col("type") == import_type)


def resolve_path(paths: DataFrame, resources: DataFrame, path: str = "path") -> DataFrame:
    """All resources on the way to each path, outermost first (``depth`` from 1)."""
    steps = paths.select(path, F.posexplode(ancestors(F.col(path))).alias("depth", "step"))
    # distinct steps are looked up once: of a root folder that all paths begin with there is one row, not one for each path
    known = steps.select("step").distinct().join(resources.select(F.col("path").alias("step"), "rid"), "step")
    found = steps.join(measured_side(known, "steps"), "step")
    return found.select(path, (F.col("depth") + 1).alias("depth"), "step", "rid")


def sort_order(spec: str | None) -> list[Column]:
    """Columns for a specifier such as ``name``, ``rid asc`` or ``lastModified desc``; ties go by rid."""
    field, _, direction = (spec or "name").partition(" ")
    direction = direction.strip().lower() or "asc"
    if field not in SORT_COLUMNS or direction not in ("asc", "desc"):
        raise ValueError(f"cannot sort by {spec!r}")
    column = F.col(SORT_COLUMNS[field])
    first = column.desc() if direction == "desc" else column.asc()
    return [first] if field == "rid" else [first, F.col("rid").asc()]


def _past(column: str, descending: bool, after: tuple) -> Column:
    """True for rows behind ``after`` = (sort value, rid) when sorted by the column and then by rid.

    As Spark sorts, rows without a value come first in ascending order and last in descending order.
    """
    key, (value, rid) = F.col(column), after
    if column == "rid":
        return key < F.lit(rid) if descending else key > F.lit(rid)
    same = key.eqNullSafe(F.lit(value)) & (F.col("rid") > rid)
    if value is None:
        return same if descending else same | key.isNotNull()
    return same | (key.isNull() | (key < F.lit(value)) if descending else F.coalesce(key > F.lit(value), F.lit(False)))


def list_children(
    resources: DataFrame,
    *,
    sort: str | None = None,
    limit: int = FILE_PAGE,
    kinds: list[str] | None = None,
    folder: str | None = None,
    after: tuple | None = None,
) -> DataFrame:
    """One page of every folder's children, or of one folder's, in the given order; ``position`` counts from 1.

    ``after`` = (sort value, rid) of the last row seen asks for the page behind it.
    """
    rows = resources.withColumn("folder", parent(F.col("path"))).withColumn("name", basename(F.col("path")))
    if folder is not None:
        rows = rows.where(F.col("folder") == folder)
    if kinds is not None:
        rows = rows.where(F.col("kind").isin(kinds))
    if after is not None:
        field = (sort or "name").partition(" ")[0]
        rows = rows.where(_past(SORT_COLUMNS[field], (sort or "").endswith("desc"), after))
    return top_per_key(rows, ["folder"], sort_order(sort), limit, "position")


def search_resources(
    resources: DataFrame,
    *,
    query: str | None = None,
    tags: list[str] | None = None,
    roles: list[str] | None = None,
    organizations: list[str] | None = None,
    sort: tuple[str, str] = ("NAME", "ASC"),
    page_size: int | None = MAX_PAGE,
    after: tuple | None = None,
) -> DataFrame:
    """One page of resources by text and membership, sorted; ``after`` = (sort value, rid) of the last row seen.

    ``page_size`` None gives everything found; :func:`search_pages` follows the pages to the end.

    Membership filters test the array columns tags, roles and organizations for any overlap.
    """
    rows = resources
    if query is not None:
        rows = rows.where(F.contains(F.lower("name"), F.lower(F.lit(query))))
    for column, wanted in (("tags", tags), ("roles", roles), ("organizations", organizations)):
        if wanted:
            rows = rows.where(F.arrays_overlap(F.col(column), F.array(*map(F.lit, wanted))))
    field, direction = sort
    if field not in SORT_FIELDS or direction not in ("ASC", "DESC"):
        raise ValueError(f"cannot sort by {sort!r}")
    key = F.col(SORT_FIELDS[field])
    if after is not None:
        rows = rows.where(_past(SORT_FIELDS[field], direction == "DESC", after))
    order = key.asc() if direction == "ASC" else key.desc()
    found = rows.orderBy(order, F.col("rid").asc())
    return found if page_size is None else found.limit(max(MIN_PAGE, page_size))


def search_pages(resources: DataFrame, *, sort: tuple[str, str] = ("NAME", "ASC"), page_size: int = MAX_PAGE, **filters) -> Iterator[list[Row]]:
    """All pages of :func:`search_resources`, one after another."""
    after = None
    while True:
        page = search_resources(resources, sort=sort, page_size=page_size, after=after, **filters).collect()
        if page:
            yield page
        if len(page) < max(MIN_PAGE, page_size):
            return
        after = (page[-1][SORT_FIELDS[sort[0]]], page[-1]["rid"])


def page_size_within(size: int, low: int = MIN_PAGE, high: int = MAX_PAGE) -> int:
    """``size`` clamped to [low, high], with a warning when it was outside."""
    clamped = max(low, min(high, size))
    if clamped != size:
        warnings.warn(f"page size {size} is outside [{low}, {high}]; using {clamped}", stacklevel=2)
    return clamped


def file_page(files: DataFrame, *, page_size: int = FILE_PAGE, start_path: str | None = None) -> DataFrame:
    """One page of each view's files by path, with the path the next page starts at (NULL on the last page).

    At most page_size + 1 rows per view are kept ahead of the window that reads the token off the extra row.
    """
    rows = files if start_path is None else files.where(F.col("path") >= start_path)
    page = top_per_key(rows, KEY, [F.col("path").asc()], page_size + 1, "position")
    extra = F.when(F.col("position") == page_size + 1, F.col("path"))
    return page.withColumn("next_page_token", F.max(extra).over(Window.partitionBy(*KEY))).where(
        F.col("position") <= page_size
    )


def events_page(events: DataFrame, types: list[str], limit: int, after: int | None = None) -> DataFrame:
    """The next ``limit`` events of the given types by id, past the cursor.

    One job: every task keeps its ``limit`` smallest ids, and the cursor is a filter of the scan.
    """
    rows = events.where(F.col("event_type").isin(types))
    if after is not None:
        rows = rows.where(F.col("event_id") > after)
    return rows.orderBy("event_id").limit(limit)


def apply_set_patches(members: DataFrame, patches: DataFrame, key: str, member: str = "member") -> DataFrame:
    """Members per key after ADD and REMOVE patches; the last patch on a (key, member) decides.

    Patches hold seq and operation. Rows stay one per member, so a set of any size is spread by member.
    """
    is_member = F.lit(1)
    base = members.select(key, member, F.lit(-1).cast("bigint").alias("seq"), is_member.alias("present"))
    change = patches.select(
        key, member, F.col("seq").cast("bigint").alias("seq"), (F.col("operation") == "ADD").cast("int").alias("present")
    )
    return (
        base.unionByName(change)
        .groupBy(key, member)
        .agg(F.max_by("present", "seq").alias("present"))
        .where(F.col("present") == 1)
        .select(key, member)
    )
