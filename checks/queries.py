"""One entry per operator; every query reads whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import inputs
from sorrel import schemas
from sorrel.functions import similarity
from sorrel.functions.ip import ip_to_num
from sorrel.functions.lists import decode_scored, encode_scored
from sorrel.operators import als, behaviour, cells, clustering, factorise, kmeans, query_log, ranges, realtime, serving, similar_lists
from sorrel.operators.joins import lookup_join
from sorrel.operators.ranking import global_index, unseen_stretches
from sorrel.operators.pruned import top_matches_pruned
from sorrel.operators.sweep import locate_by_sweep
from sorrel.operators.topk import as_lists, as_rows, nearest_to_one, top_matches
from sorrel.session import materialise
from sorrel.sources.files import catalogue_table
from sorrel.sources.streams import parse_changes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ID, VEC = "vec_id", "embedding"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _shown(ranked: DataFrame, score: str = "sim") -> DataFrame:
    return ranked.select("base", "item", F.col("score").alias(score), F.col("rank").cast("int").alias("rank"))


# Locations ---------------------------------------------------------------------


@query
def ip_to_num_(spark, d):
    text = F.when(F.col("event_type") == "error", F.lit("256.1.1.1")).when(
        F.col("event_type") == "signup", F.substring_index("ip", ".", 3)
    ).otherwise(F.col("ip"))
    return inputs.access_log(spark, d).select("event_id", F.coalesce(ip_to_num(text), F.lit(-1)).alias("ip_num"))


@query
def ip_location(spark, d):
    located = ranges.ip_location(inputs.access_log(spark, d), inputs.ip_ranges(spark, d), "ip_num", ["event_id"])
    return located.select("event_id", "ip", "ip_num", F.coalesce("location", F.lit("")).alias("location"))


@query
def ip_location_count(spark, d):
    return ranges.location_counts(inputs.access_log(spark, d), inputs.ip_ranges(spark, d), "ip_num")


@query
def ip_location_count_sweep(spark, d):
    return ranges.location_counts(inputs.access_log(spark, d), inputs.ip_ranges(spark, d), "ip_num", locate=locate_by_sweep)


@query
def ip_location_sweep(spark, d):
    log, known = inputs.access_log(spark, d), inputs.ip_ranges(spark, d)
    located = ranges.ip_location(log, known, "ip_num", ["event_id"], locate=locate_by_sweep)
    return located.select("event_id", "ip", "ip_num", F.coalesce("location", F.lit("")).alias("location"))


# Similarities and nearest items -------------------------------------------------


def _pairs(spark, d):
    one = inputs.vectors(spark, d).select(F.col(ID).alias("a"), F.col(VEC).alias("va"))
    other = inputs.vectors(spark, d).select((F.col(ID) - 1).alias("a"), F.col(VEC).alias("vb"))
    return one.join(other, "a")


def _similarity(name: str) -> Query:
    def run(spark, d):
        value = similarity.METRICS[name](F.col("va"), F.col("vb"))
        return _pairs(spark, d).select("a", F.round(value, 6).alias("value"))

    return run


def _vector_similarity(name: str) -> Query:
    def run(spark, d):
        one, other = (array_to_vector(F.col(c).cast("array<double>")) for c in ("va", "vb"))
        return _pairs(spark, d).select("a", F.round(similarity.VECTOR_METRICS[name](one, other), 6).alias("value"))

    return run


for _name in similarity.METRICS:
    QUERIES[f"sim_{_name}"] = _similarity(_name)
    QUERIES[f"sim_{_name}_vector"] = _vector_similarity(_name)


@query
def topn_cosine(spark, d):
    found = top_matches(inputs.vectors(spark, d), None, schemas.SIMILAR_PER_ITEM, "cosine", ID, VEC)
    return _shown(found)


@query
def topn_pearson(spark, d):
    found = top_matches(inputs.vectors(spark, d), None, schemas.SIMILAR_PER_ITEM, "pearson", ID, VEC)
    return _shown(found)


@query
def topn_adjusted_cosine(spark, d):
    found = top_matches(inputs.vectors(spark, d), None, schemas.SIMILAR_PER_ITEM, "adjusted_cosine", ID, VEC)
    return _shown(found)


@query
def topn_euclidean(spark, d):
    found = top_matches(inputs.vectors(spark, d), None, schemas.SIMILAR_PER_ITEM, "euclidean", ID, VEC)
    return _shown(found, "dist")


def _bounded(items):
    """Blocks of a sixteenth of the items, whose bounds are relied on to the end."""
    return {"block_rows": max(16, items.count() // 16), "worth": 1.0}


@query
def topn_cosine_bounds(spark, d):
    items = inputs.vectors(spark, d)
    return _shown(top_matches_pruned(items, None, schemas.SIMILAR_PER_ITEM, "cosine", ID, VEC, **_bounded(items)))


@query
def topn_euclidean_bounds(spark, d):
    items = inputs.vectors(spark, d)
    found = top_matches_pruned(items, None, schemas.SIMILAR_PER_ITEM, "euclidean", ID, VEC, **_bounded(items))
    return _shown(found, "dist")


def _first_id(spark, d):
    return inputs.vectors(spark, d).agg(F.min(ID)).head()[0]


@query
def nearest_euclidean(spark, d):
    found = nearest_to_one(inputs.vectors(spark, d), _first_id(spark, d), 6, "euclidean", ID, VEC)
    return found.select("item", F.round("score", 10).alias("dist"))


@query
def nearest_pearson(spark, d):
    found = nearest_to_one(inputs.vectors(spark, d), _first_id(spark, d), 6, "pearson", ID, VEC)
    return found.select("item", F.round("score", 10).alias("sim"))


def _lists(spark, d):
    """The prepared lists, held as a stored table would be."""
    return materialise(similar_lists.build(inputs.vectors(spark, d), ID, VEC))


@query
def topn_encode(spark, d):
    return _lists(spark, d).select("base", encode_scored(F.col("entries"), digits=10).alias("value"))


@query
def topn_decode(spark, d):
    text = _lists(spark, d).select("base", encode_scored(F.col("entries"), digits=10).alias("value"))
    return _shown(as_rows(text.select("base", decode_scored(F.col("value")).alias("entries"))))


@query
def cluster_nearest(spark, d):
    found = clustering.nearest_in_cluster(inputs.vectors(spark, d), ID, VEC, "label")
    return found.select(F.col("label").cast("int").alias("label"), "base", "item", F.col("score").alias("dist"), F.col("rank").cast("int").alias("rank"))


@query
def kmeans_bounded(spark, d):
    data = kmeans.prepared(inputs.vectors(spark, d), ID, VEC)
    found = kmeans.lloyd(data, kmeans.hash_seeds(data, 5), 3)[-1]
    sums = found.assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_items"), F.round(F.sum("square"), 6).alias("cost"))
    return sums.select(F.col("cluster").cast("int").alias("cluster"), "n_items", "cost")


@query
def cluster_nearest_bounds(spark, d):
    items = inputs.vectors(spark, d)
    found = top_matches_pruned(items, None, schemas.NEAREST_IN_CLUSTER, "euclidean", ID, VEC, "label", **_bounded(items))
    return found.select(F.col("label").cast("int").alias("label"), "base", "item", F.col("score").alias("dist"), F.col("rank").cast("int").alias("rank"))


# Clusters -----------------------------------------------------------------------


def _assigned(spark, d):
    vectors = inputs.vectors(spark, d)
    return clustering.nearest_centroid(vectors, ID, VEC, clustering.centroids(vectors, "label", VEC), "label")


@query
def nearest_centroid(spark, d):
    return _assigned(spark, d).select(ID, F.col("cluster").cast("int").alias("cluster"), "distance")


@query
def wssse(spark, d):
    return clustering.within_cost(_assigned(spark, d)).select(F.round("wssse", 4).alias("wssse"))


@query
def cluster_sizes(spark, d):
    return clustering.cluster_sizes(_assigned(spark, d)).withColumn("cluster", F.col("cluster").cast("int"))


@query
def kmeans_assign(spark, d):
    vectors = inputs.vectors(spark, d)
    model = clustering.fit(vectors, VEC, 6, 20)
    return clustering.assign(model, vectors, VEC).select(ID, "cluster")


@query
def kmeans_grid(spark, d):
    return clustering.grid_search(inputs.vectors(spark, d), VEC)[1]


# Features, JSON and cells -------------------------------------------------------


@query
def feature_vector(spark, d):
    items, n = inputs.part_features(spark, d), len(schemas.FEATURES)
    shaped = clustering.feature_vector(items, schemas.FEATURES).where("features is not null")
    good = shaped.select("schoolid", *[F.col("features")[i].alias(f"f{i}") for i in range(n)], F.lit("").alias("rejected"))
    bad = clustering.rejected_features(items, schemas.FEATURES).select(
        "schoolid", *[F.lit(-1.0).alias(f"f{i}") for i in range(n)], F.array_join("reject_columns", ",").alias("rejected")
    )
    return good.unionByName(bad)


@query
def scan_catalog_table(spark, d):
    inputs.part_features(spark, d).createOrReplaceTempView("sorrel_items")
    return catalogue_table(spark, "sorrel_items").select("schoolid", "schoolname", "locationid", "zs")


@query
def json_fields(spark, d):
    return parse_changes(inputs.change_messages(spark, d))


def _customers(spark, d):
    return inputs.table(spark, d, "customer")


@query
def cells_unpivot(spark, d):
    return cells.to_cells(_customers(spark, d), "c_custkey")


@query
def cells_sorted(spark, d):
    ordered = cells.to_cells(inputs.table(spark, d, "supplier"), "s_suppkey")
    return global_index(ordered, [F.col("rowkey"), F.col("qualifier")], "position")


# Behaviours ---------------------------------------------------------------------


@query
def parse_behaviour(spark, d):
    parsed = behaviour.parse_messages(inputs.messages(spark, d))
    return parsed.select(
        "event_id",
        *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("user_id", "item_id")],
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("operation", "reject_reason")],
    )


@query
def parse_indexed_rating(spark, d):
    user = F.when(F.col("event_type") == "purchase", F.col("user_id").cast("bigint") + inputs.LARGE_ID).otherwise(F.col("user_id"))
    lines = inputs.events(spark, d).select("event_id", F.concat(
        F.lit("(("), user.cast("string"), F.lit(","), F.col("k").cast("string"),
        F.when(F.col("event_type") == "error", F.lit("")).when(F.col("event_type") == "signup", F.lit(",x")).otherwise(F.lit(",1.5")),
        F.lit("),"), F.col("event_id").cast("string"), F.lit(")"),
    ).alias("value"))
    parsed = behaviour.parse_indexed_ratings(lines)
    return parsed.select(
        "event_id", *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("user_id", "item_id", "index")],
        F.coalesce("score", F.lit(-1.0)).alias("score"), F.coalesce("reject_reason", F.lit("")).alias("reject_reason"),
    )


def _scores(spark, d, weights=schemas.OFFLINE_WEIGHTS):
    return behaviour.score(inputs.behaviours(spark, d), weights)


def _score_shown(scores):
    return scores.select("user_id", "item_id", F.round("score", 6).alias("score"))


@query
def score_offline(spark, d):
    return _score_shown(_scores(spark, d))


@query
def score_stream(spark, d):
    parsed = behaviour.parse_messages(inputs.messages(spark, d))
    return _score_shown(behaviour.score(behaviour.accepted(parsed), schemas.STREAM_WEIGHTS))


@query
def user_profile(spark, d):
    pages = behaviour.user_profile(_scores(spark, d))
    shown = F.transform("items", lambda e: F.format_string("%d:%.2f", e["item_id"], e["score"]))
    return pages.select("user_id", "page", F.array_join(shown, ",").alias("items"))


@query
def ratings_split(spark, d):
    split = behaviour.split_bucket(_scores(spark, d))
    return split.select("user_id", "item_id", "bucket", behaviour.split_name(F.col("bucket")).alias("part"))


@query
def rating_index(spark, d):
    return behaviour.rating_index(_scores(spark, d)).select("user_id", "item_id", "index")


@query
def rmse(spark, d):
    split = als.fixed_split(_scores(spark, d))
    mean = split.where("part = 'train'").groupBy("user_id").agg(F.avg("score").alias("prediction"))
    pairs = lookup_join(split.where("part = 'validation'"), mean, ["user_id"], ["item_id"])
    return behaviour.rmse(pairs, "prediction", "score").select(F.round("rmse", 6).alias("rmse"))


@query
def unseen_candidates(spark, d):
    """Some users have touched only items that the catalogue does not hold."""
    catalogue = inputs.vectors(spark, d).select(F.col(ID).alias("item_id"))
    outside = F.when(F.col("user_id") % 25 == 7, F.col("item_id") + 10_000_000).otherwise(F.col("item_id"))
    return unseen_stretches(inputs.behaviours(spark, d).select("user_id", outside.alias("item_id")), catalogue)


@query
def user_item_list(spark, d):
    return _top_lists(spark, d).select("key", "value")


def _top_lists(spark, d):
    """The best items of every user by own score, as prepared lists."""
    from pyspark.sql import Window

    order = Window.partitionBy("user_id").orderBy(F.round("score", 6).desc(), F.col("item_id"))
    best = _scores(spark, d).withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= schemas.UNSEEN_PER_USER
    )
    return serving.paged_ids(best.withColumn("key", F.col("user_id").cast("string")), "key", "item_id", "rank")


# Serving and real time ----------------------------------------------------------


def _writes(spark, d, ttl=None, fine=False):
    key = F.concat_ws(":", F.col("user_id").cast("string"), F.col("k").cast("string")) if fine else F.col("user_id")
    return serving.puts(
        inputs.events(spark, d), "profile", key, F.col("k"), F.col("ts").cast("timestamp"), F.col("event_id"), ttl
    )


@query
def kv_upsert(spark, d):
    before = inputs.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    start = F.lit("2000-01-01 00:00:00").cast("timestamp")
    current = serving.puts(before, "profile", F.col("c_custkey"), F.col("c_nationkey"), start, F.lit(0))
    return serving.upsert(current, _writes(spark, d)).select("namespace", "key", "value", "seq")


@query
def kv_ttl_live(spark, d):
    state = serving.latest(_writes(spark, d, schemas.TTL_DAYS, fine=True))
    now = F.lit("2024-01-30 00:00:00").cast("timestamp")
    return serving.live(state, now).select("namespace", "key", "value", "seq")


@query
def kv_delete(spark, d):
    state = serving.latest(_writes(spark, d, fine=True))
    gone = inputs.events(spark, d).where("event_type = 'error'").select(
        F.lit("profile").alias("namespace"),
        F.concat_ws(":", F.col("user_id").cast("string"), F.col("k").cast("string")).alias("key"),
    )
    return serving.delete(state, gone).select("namespace", "key", "value", "seq")


@query
def realtime_cb(spark, d):
    ranked = realtime.content_recommendations(_scores(spark, d, schemas.STREAM_WEIGHTS), _lists(spark, d))
    return ranked.select("user_id", "item", F.round("weight", 6).alias("weight"), "rank")


@query
def realtime_cb_limited(spark, d):
    ranked = realtime.content_recommendations(_scores(spark, d, schemas.STREAM_WEIGHTS), _lists(spark, d), limit=7)
    pages = serving.paged_ids(ranked.withColumn("key", F.col("user_id").cast("string")), "key", "item", "rank")
    return pages.select("key", "value")


@query
def realtime_als(spark, d):
    """Prepared lists exist for users whose last event is not an error; the others get the default."""
    last = inputs.events(spark, d).groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("last"))
    listed = last.where("last <> 'error'").select(F.col("user_id").cast("string").alias("key"))
    stored = _top_lists(spark, d).join(listed, "key")
    return realtime.prepared_recommendations(_scores(spark, d, schemas.STREAM_WEIGHTS), stored, "0,1,2").select("key", "value")


# Upkeep of the lists ------------------------------------------------------------


def _changed(spark, d, kind):
    events = parse_changes(inputs.change_messages(spark, d))
    latest = materialise(similar_lists.latest_changes(events, "event_id"))
    return latest.where(F.col("type") == kind).select(F.col("sid").alias("base"))


@query
def latest_changes(spark, d):
    return similar_lists.latest_changes(parse_changes(inputs.change_messages(spark, d)), "event_id")


@query
def topn_for_subset(spark, d):
    return _shown(similar_lists.build_for(_changed(spark, d, "update"), inputs.vectors(spark, d), ID, VEC))


@query
def topn_apply_add(spark, d):
    added, vectors = _changed(spark, d, "add"), inputs.vectors(spark, d)
    before = vectors.join(added.select(F.col("base").alias(ID)), ID, "left_anti")
    lists = materialise(similar_lists.build(before, ID, VEC))
    after = similar_lists.apply_add(lists, added, vectors, ID, VEC)
    return _shown(as_rows(after))


@query
def topn_apply_delete(spark, d):
    after = similar_lists.apply_delete(_lists(spark, d), _changed(spark, d, "delete"))
    return after.select("base", encode_scored(F.col("entries"), digits=10).alias("value"))


@query
def topn_apply_update(spark, d):
    updated, vectors = _changed(spark, d, "update"), inputs.vectors(spark, d)
    marks = updated.select(F.col("base").alias(ID), F.lit(True).alias("_old"))
    before = lookup_join(vectors, marks, [ID], [ID], "left").select(
        ID, F.when(F.col("_old"), F.reverse(VEC)).otherwise(F.col(VEC)).alias(VEC)
    )
    lists = materialise(similar_lists.build(before, ID, VEC))
    after = similar_lists.apply_update(lists, updated, vectors, ID, VEC)
    return _shown(as_rows(after))


@query
def topn_delete_then_update(spark, d):
    """Deletions shorten lists; a later update must not fill them up."""
    deleted, updated, vectors = _changed(spark, d, "delete"), _changed(spark, d, "update"), inputs.vectors(spark, d)
    marks = updated.select(F.col("base").alias(ID), F.lit(True).alias("_old"))
    before = lookup_join(vectors, marks, [ID], [ID], "left").select(
        ID, F.when(F.col("_old"), F.reverse(VEC)).otherwise(F.col(VEC)).alias(VEC)
    )
    lists = materialise(similar_lists.apply_delete(similar_lists.build(before, ID, VEC), deleted))
    live = vectors.join(deleted.select(F.col("base").alias(ID)), ID, "left_anti")
    return _shown(as_rows(similar_lists.apply_update(lists, updated, live, ID, VEC)))


# Query logs ---------------------------------------------------------


def _flagged(found, *columns):
    return found.withColumns({c: F.coalesce(c, F.lit("")) for c in columns})


@query
def query_log_tables(spark, d):
    return _flagged(query_log.tables(inputs.query_log(spark, d), "query_id", "sql"), "database", "table")


@query
def query_log_columns(spark, d):
    found = query_log.selected_columns(inputs.query_log(spark, d), "query_id", "sql", inputs.column_catalogue(spark, d))
    return _flagged(found, "table", "column")


@query
def catalog_ddl(spark, d):
    lines = inputs.table(spark, d, "lineitem").select(
        F.concat(F.lit("order_"), F.col("l_orderkey").cast("string")).alias("table"),
        F.col("l_linenumber").alias("position"),
        F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("column"),
        F.when(F.col("l_returnflag") == "A", "string").when(F.col("l_returnflag") == "N", "double").otherwise("bigint").alias("type"),
    )
    return query_log.ddl(lines)


# Matrix factorisation -----------------------------------------------------------


@query
def als_factors(spark, d):
    return als.factors(als.fit(_scores(spark, d)))


@query
def als_block_factors(spark, d):
    found = factorise.factorise(_scores(spark, d), rank=2, iterations=2, reg=0.1)
    both = found.users.withColumn("kind", F.lit("user")).unionByName(found.items.withColumn("kind", F.lit("item")))
    value = lambda i: F.round(F.col("features")[i], 6).alias(f"f{i}")
    return both.select("kind", "id", value(0), value(1))


@query
def als_grid(spark, d):
    return als.grid_search(_scores(spark, d))[1]


def _factors(spark, d):
    """Ratings, and factors that SQL can work out too, in the place of fitted ones."""
    ratings = materialise(_scores(spark, d))
    items = inputs.item_factors(spark, d)
    return ratings, materialise(inputs.user_factors(items, ratings)), items


def _rated(found, rating="rating"):
    return found.withColumn(rating, F.round(rating, 10)).withColumn("rank", F.col("rank").cast("int"))


@query
def als_predict(spark, d):
    ratings, users, items = _factors(spark, d)
    found = als.predict(users, items, ratings.select("user_id", "item_id"))
    return found.withColumn("prediction", F.round("prediction", 8))


@query
def als_topn_unseen(spark, d):
    ratings, users, items = _factors(spark, d)
    return _rated(als.top_unseen(users, items, ratings, ratings.select("item_id").distinct()))


@query
def als_topn_unseen_bounds(spark, d):
    ratings, users, items = _factors(spark, d)
    catalogue = ratings.select("item_id").distinct()
    return _rated(als.top_unseen(users, items, ratings, catalogue, **_bounded(items)))


@query
def als_items_for_user(spark, d):
    ratings, users, items = _factors(spark, d)
    return _rated(als.items_for_users(users, items, 10, ratings.agg(F.min("user_id").alias("user_id"))))


@query
def als_named(spark, d):
    _, users, items = _factors(spark, d)
    names = inputs.table(spark, d, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"))
    return _rated(als.named(als.items_for_users(users, items, 10), names, digits=6))


@query
def als_users_for_item(spark, d):
    ratings, users, items = _factors(spark, d)
    return _rated(als.users_for_items(users, items, 10, ratings.agg(F.min("item_id").alias("item_id"))))


@query
def als_users_for_items(spark, d):
    _, users, items = _factors(spark, d)
    return _rated(als.users_for_items(users, items, 10))


@query
def als_similar_items(spark, d):
    return _shown(als.similar_items(inputs.item_factors(spark, d), 10))


QUERIES["ip_to_num"] = QUERIES.pop("ip_to_num_")
