"""Queries on catalog lookups and listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import catalog, transactions
from tidemark.plans import derived as d
from tidemark.plans.registry import query
from tidemark.plans.store import Store


@query(f"""WITH {d.LOG}, last AS (SELECT rid, max(seq) AS seq FROM log WHERE {d.COMMITTED} GROUP BY rid),
ids AS (SELECT '/proj/d' || (CAST(substr(rid, 3) AS INT) % 15) AS dataset_path,
  'ri.catalog.main.dataset.' || substr(rid, 3) AS dataset_rid, seq FROM last),
req AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN '/proj/d' || (user_id % 25)
  ELSE 'ri.catalog.main.dataset.' || (user_id % 25) END AS ref FROM events),
hit AS (SELECT event_id, ref, count(dataset_rid) AS hits, max(dataset_path) AS p, max(dataset_rid) AS r, max(seq) AS s
  FROM req LEFT JOIN ids ON ref = CASE WHEN starts_with(ref, 'ri.') THEN dataset_rid ELSE dataset_path END GROUP BY event_id, ref)
SELECT event_id, ref, hits, CASE WHEN hits = 1 THEN p END AS dataset_path, CASE WHEN hits = 1 THEN r END AS dataset_rid,
  CASE WHEN hits = 1 THEN s END AS seq FROM hit""")
def identity_lookup(spark, sf):
    """Requests by path and by rid; some paths name two datasets, some none."""
    last = transactions.last_transactions(d.event_log(spark, sf), keys=["rid"])
    number = F.substring("rid", 3, 9)
    identities = last.select(
        d.text("/proj/d", number.cast("int") % 15).alias("dataset_path"),
        d.text("ri.catalog.main.dataset.", number).alias("dataset_rid"),
        "seq",
    )
    user = F.col("user_id") % 25
    ref = F.when(F.col("event_id") % 2 == 0, d.text("/proj/d", user)).otherwise(d.text("ri.catalog.main.dataset.", user))
    return catalog.identity_lookup(d.table(spark, sf, "events").select("event_id", ref.alias("ref")), identities)


@query(f"WITH {d.RESOURCES}, {d.IMPORTS} SELECT o_orderkey, rid, path FROM imp LEFT JOIN res USING (rid)")
def paths_for_rids(spark, sf):
    return catalog.paths_for_rids(d.imports(spark, sf).select("o_orderkey", "rid"), d.resources(spark, sf))


@query(f'WITH {d.RESOURCES}, {d.IMPORTS} SELECT o_orderkey, i.rid, r.rid IS NOT NULL AS "exists" FROM imp i LEFT JOIN res r ON i.rid = r.rid')
def resources_exist(spark, sf):
    return catalog.resources_exist(d.imports(spark, sf).select("o_orderkey", "rid"), d.resources(spark, sf))


@query(f"WITH {d.RESOURCES}, {d.IMPORTS} SELECT o_orderkey, rid, type FROM imp WHERE rid NOT IN (SELECT rid FROM res)")
def dangling_imports(spark, sf):
    return catalog.dangling_imports(d.imports(spark, sf), d.resources(spark, sf))


@query(f"WITH {d.IMPORTS} SELECT o_orderkey, rid, type FROM imp WHERE type = 'EXTERNAL'")
def imports_by_type(spark, sf):
    return catalog.imports_by_type(d.imports(spark, sf), "EXTERNAL")


@query(f"""WITH {d.RESOURCES}, steps AS (SELECT path, unnest([1, 2, 3]) AS depth,
  unnest(['/' || split_part(path, '/', 2), '/' || split_part(path, '/', 2) || '/' || split_part(path, '/', 3), path]) AS step FROM res)
SELECT s.path, s.depth, s.step, a.rid FROM steps s JOIN (SELECT rid, path FROM res UNION ALL SELECT rid, path FROM fold) a ON a.path = s.step""")
def resolve_path(spark, sf):
    named = d.resources(spark, sf).select("rid", "path")
    return catalog.resolve_path(named.select("path"), named.unionByName(d.folders(spark, sf)))


@query(f"""WITH {d.RESOURCES}, everything AS (SELECT rid, path FROM res UNION ALL SELECT rid, path FROM fold),
kids AS (SELECT rid, path, list_extract(string_split(path, '/'), -1) AS name,
  CASE WHEN regexp_replace(path, '/[^/]*$', '') = '' THEN '/' ELSE regexp_replace(path, '/[^/]*$', '') END AS folder FROM everything)
SELECT folder, rid, path, name, CAST(row_number() OVER (PARTITION BY folder ORDER BY name DESC, rid) AS INT) AS position
FROM kids QUALIFY position <= 20""")
def list_children_sorted(spark, sf):
    named = d.resources(spark, sf).select("rid", "path").unionByName(d.folders(spark, sf))
    return catalog.list_children(named, sort="name desc", limit=20)


@query(f"""WITH {d.RESOURCES} SELECT rid, path, name FROM res WHERE contains(lower(name), 'r#000000')
  AND (c_mktsegment IN ('BUILDING', 'ASIA') OR r_name IN ('BUILDING', 'ASIA')) ORDER BY name DESC, rid LIMIT 100""")
def search_resources(spark, sf):
    found = catalog.search_resources(
        d.resources(spark, sf), query="R#000000", tags=["BUILDING", "ASIA"], sort=("NAME", "DESC"), page_size=100
    )
    return found.select("rid", "path", "name")


@query("""WITH hits AS (SELECT c_mktsegment AS segment, count(*) AS members FROM customer GROUP BY c_mktsegment)
SELECT '/segments/' || segment AS path, members, members % 2 = 1 AS trashed FROM hits""")
def trashed_datasets(spark, sf):
    """A dataset for each market segment, those with an odd number of members moved to the trash, one moved there and back."""
    store = Store(spark)
    sizes = d.table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias("members")).collect()
    for segment, members in sizes:
        ds = store.create_dataset(f"/segments/{segment}")
        ds.save_dataframe(d.table(spark, sf, "customer").where(F.col("c_mktsegment") == segment).select("c_custkey"))
        store.set_trashed(ds.rid, True)
        if members % 2 == 0:
            store.set_trashed(ds.path, False)
    known = spark.createDataFrame([(f"/segments/{segment}", members) for segment, members in sizes], "path string, members bigint")
    return store.datasets().join(known, "path").select("path", "members", "trashed")


@query("""SELECT CAST(c_custkey AS BIGINT) AS rid, CASE WHEN c_custkey % 3 > 0 THEN c_name END AS name, direction
FROM customer, (SELECT unnest(['ASC', 'DESC']) AS direction) d WHERE c_custkey % 50 < 2""")
def search_null_names(spark, sf):
    """All pages of a search in which a third of the names are missing, in both directions."""
    key = F.col("c_custkey").cast("long")
    named = d.table(spark, sf, "customer").where(key % 50 < 2).select(key.alias("rid"), F.when(key % 3 > 0, F.col("c_name")).alias("name"))
    rows = [
        (r["rid"], r["name"], direction)
        for direction in ("ASC", "DESC")
        for page in catalog.search_pages(named, sort=("NAME", direction), page_size=max(2, named.count() // 6))
        for r in page
    ]
    return spark.createDataFrame(rows, "rid bigint, name string, direction string")


@query("""WITH kids AS (SELECT '/' || c_mktsegment AS folder, CAST(c_custkey AS BIGINT) AS rid, CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 30 END AS modified
  FROM customer), ranked AS (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY modified NULLS FIRST, rid) AS n FROM kids)
SELECT folder, rid, CAST(n - 2 * (c // 3) AS INT) AS position FROM ranked JOIN (SELECT folder AS f, count(*) AS c FROM kids GROUP BY folder) s ON s.f = folder
WHERE n > 2 * (c // 3) AND n <= 3 * (c // 3)""")
def children_null_dates(spark, sf):
    """The third page of every folder's children by date, a quarter of which have none."""
    key = F.col("c_custkey").cast("long")
    children = d.table(spark, sf, "customer").select(
        d.text("/", F.col("c_mktsegment"), "/", key).alias("path"), key.alias("rid"), F.when(key % 4 > 0, key % 30).alias("last_modified")
    )
    found = None
    for folder, size in children.groupBy(F.substring_index("path", "/", 2)).count().collect():
        after = None
        for _ in range(3):
            page = catalog.list_children(children, sort="lastModified", limit=size // 3, folder=folder, after=after)
            last = page.orderBy(F.col("position").desc()).first()
            after = (last["last_modified"], last["rid"])
        page = page.select("folder", "rid", "position")
        found = page if found is None else found.unionAll(page)
    return found


@query("""SELECT event_id, event_type, user_id FROM events WHERE event_type IN ('click', 'error') AND event_id > 100
ORDER BY event_id LIMIT 1000""")
def events_by_type_page(spark, sf):
    page = catalog.events_page(d.table(spark, sf, "events"), ["click", "error"], 1000, after=100)
    return page.select("event_id", "event_type", "user_id")


@query("""WITH base AS (SELECT DISTINCT user_id % 50 AS grp, 'p' || (event_id % 40) AS member FROM events WHERE event_type = 'view'),
p AS (SELECT user_id % 50 AS grp, 'p' || (event_id % 40) AS member, event_id, event_type = 'click' AS present FROM events
  WHERE event_type IN ('click', 'error')),
allp AS (SELECT grp, member, -1 AS event_id, true AS present FROM base UNION ALL SELECT * FROM p)
SELECT grp, member FROM (SELECT grp, member, arg_max(present, event_id) AS present FROM allp GROUP BY grp, member) x WHERE present""")
def apply_set_patches(spark, sf):
    """Views found the groups; clicks add members and errors remove them, in the order of events."""
    events = d.table(spark, sf, "events").select(
        (F.col("user_id") % 50).alias("grp"), d.text("p", F.col("event_id") % 40).alias("member"), F.col("event_id").alias("seq"), "event_type"
    )
    patches = events.where(F.col("event_type").isin("click", "error")).withColumn(
        "operation", F.when(F.col("event_type") == "click", "ADD").otherwise("REMOVE")
    )
    return catalog.apply_set_patches(events.where("event_type = 'view'").select("grp", "member"), patches, "grp")
