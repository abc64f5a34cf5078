"""Test queries for feature preparation, models and the model-building jobs (2.8, 2.9).

Feature transformers and metrics have SQL oracles.  The numbers of fitted
models depend on Spark ML's solvers and seeds; their queries fit and apply the
model and return what SQL can tell as well (which rows are held out, with
which labels, how many) beside conditions that only a right fit meets: the
optimality conditions of the regressions' own objectives, tree probabilities
that beat the simplest cut, centres that are settled and nearest, scores that
are the factors' products.  A model put in the fit's place breaks them.
"""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidewater.functions.columns import binary_label, category_group
from tidewater.operators import features as FE
from tidewater.operators import models as M
from tidewater.operators import recommend as RC
from tidewater.operators import tuning as TU
from tidewater.operators.relational import lookup
from tidewater.plans import model_jobs as MJ
from tidewater.plans.registry import half_up, register
from tidewater.session import checkpoint_root, remove_at_exit, scratch_path, written
from tidewater.sources.tables import Tables

_PRIORITY_RANK = """
with c as (select o_orderpriority as v, count(*) as n from orders group by 1),
     r as (select v, cast(row_number() over (order by n desc, v) - 1 as double) as idx from c)"""


def _priority_indexed(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderpriority")
    return FE.index_strings(o, {"o_orderpriority": "priority_index"})


@register("string_index", _PRIORITY_RANK + """
select o.o_orderkey, r.idx as priority_index from orders o join r on o.o_orderpriority = r.v""")
def q_string_index(spark, sf):
    df, _ = _priority_indexed(spark, sf)
    return df.select("o_orderkey", "priority_index")


@register("index_to_string", _PRIORITY_RANK + """
select idx as priority_index, v as priority from r""")
def q_index_to_string(spark, sf):
    df, _ = _priority_indexed(spark, sf)
    distinct = df.select("priority_index").distinct()
    return FE.index_to_string(distinct, "priority_index", "priority")


@register("one_hot", _PRIORITY_RANK + """
select o.o_orderkey,
       cast(case when r.idx = 0 then 1.0 else 0.0 end as double) as oh0,
       cast(case when r.idx = 1 then 1.0 else 0.0 end as double) as oh1,
       cast(case when r.idx = 2 then 1.0 else 0.0 end as double) as oh2,
       cast(case when r.idx = 3 then 1.0 else 0.0 end as double) as oh3
from orders o join r on o.o_orderpriority = r.v""")
def q_one_hot(spark, sf):
    df, _ = _priority_indexed(spark, sf)
    enc = FE.one_hot(df, ["priority_index"], ["priority_vector"])
    return FE.vector_elements(enc, "priority_vector", 4, "oh", keep=["o_orderkey"])


@register("assemble_vector", """
select l_orderkey, l_linenumber, l_quantity as f0, l_discount as f1, l_tax as f2 from lineitem""")
def q_assemble_vector(spark, sf):
    li = Tables(spark, sf).lineitem
    v = FE.assemble(li, ["l_quantity", "l_discount", "l_tax"], "features")
    return FE.vector_elements(v, "features", 3, "f", keep=["l_orderkey", "l_linenumber"])


def _point(*keys: str) -> str:
    return FE.split_point_sql(keys, 42)


@register("random_split", f"""
select o_orderkey, case when {_point("o_orderkey")} < 0.8 then 0 else 1 end as part from orders""")
def q_random_split(spark, sf):
    o = Tables(spark, sf).orders.select("o_orderkey")
    train, holdout = FE.seeded_split(o, [0.8, 0.2], "o_orderkey", 42)
    return train.withColumn("part", F.lit(0)).unionByName(holdout.withColumn("part", F.lit(1)))


@register("linear_regression", f"""
select {half_up("regr_slope(l_extendedprice, l_quantity)", 4)} as slope,
       {half_up("regr_intercept(l_extendedprice, l_quantity)", 4)} as intercept,
       {half_up("regr_r2(l_extendedprice, l_quantity)", 6)} as r2
from lineitem""")
def q_linear_regression(spark, sf):
    li = Tables(spark, sf).lineitem.select(F.col("l_extendedprice").alias("label"), "l_quantity")
    data = FE.assemble(li, ["l_quantity"])
    model = M.linear_regression().fit(data)
    row = [(float(model.coefficients[0]), float(model.intercept), float(model.summary.r2))]
    fit = spark.createDataFrame(row, "slope double, intercept double, r2 double")
    return fit.select(F.round("slope", 4).alias("slope"), F.round("intercept", 4).alias("intercept"),
                      F.round("r2", 6).alias("r2"))


_SSE = "sum(power(l_extendedprice - l_quantity * 1500.0, 2))"


@register("regression_metrics", f"""
select {half_up(f"1 - {_SSE} / (var_samp(l_extendedprice) * (count(*) - 1))", 6)} as r2,
       {half_up(f"sqrt({_SSE} / count(*))", 6)} as rmse,
       count(*) as n
from lineitem""")
def q_regression_metrics(spark, sf):
    li = Tables(spark, sf).lineitem.select(
        F.col("l_extendedprice").alias("label"),
        (F.col("l_quantity") * F.lit(1500.0)).alias("prediction"))
    m = M.regression_metrics(li)
    return m.select(F.round("r2", 6).alias("r2"), F.round("rmse", 6).alias("rmse"), "n")


def _labelled_docs(spark, sf):
    t = Tables(spark, sf)
    return t.documents.select("doc_id", "n_chars", "lang", "source").join(t.labels, "doc_id")


_RULE_PRED = "cast(case when d.n_chars > 5000 then 1.0 else 0.0 end as double)"
_RULE_FROM = "from documents d join labels l on d.doc_id = l.doc_id"


def _rule_predictions(spark, sf):
    d = _labelled_docs(spark, sf)
    return d.select("doc_id", F.col("quality").cast("double").alias("label"),
                    F.when(F.col("n_chars") > 5000, 1.0).otherwise(0.0).alias("prediction"))


@register("classification_summary", f"""
select avg(case when cast(l.quality as double) = {_RULE_PRED} then 1.0 else 0.0 end) as accuracy,
       sum(case when l.quality = 0 and {_RULE_PRED} = 0 then 1.0 else 0.0 end)
         / sum(case when l.quality = 0 then 1.0 else 0.0 end) as tpr_0,
       sum(case when l.quality = 1 and {_RULE_PRED} = 1 then 1.0 else 0.0 end)
         / sum(case when l.quality = 1 then 1.0 else 0.0 end) as tpr_1,
       sum(case when l.quality <> 0 and {_RULE_PRED} = 0 then 1.0 else 0.0 end)
         / sum(case when l.quality <> 0 then 1.0 else 0.0 end) as fpr_0,
       sum(case when l.quality <> 1 and {_RULE_PRED} = 1 then 1.0 else 0.0 end)
         / sum(case when l.quality <> 1 then 1.0 else 0.0 end) as fpr_1
{_RULE_FROM}""")
def q_classification_summary(spark, sf):
    return M.classification_summary(_rule_predictions(spark, sf))


@register("confusion_table", f"""
select cast(l.quality as double) as label, {_RULE_PRED} as prediction, count(*) as count
{_RULE_FROM} group by 1, 2""")
def q_confusion_table(spark, sf):
    return M.confusion_table(_rule_predictions(spark, sf))


@register("multiclass_accuracy", f"""
select avg(case when cast(l.quality as double) = {_RULE_PRED} then 1.0 else 0.0 end) as accuracy
{_RULE_FROM}""")
def q_multiclass_accuracy(spark, sf):
    return M.accuracy(_rule_predictions(spark, sf))


def _lineitem_regression_frame(spark, sf):
    t = Tables(spark, sf)
    part = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_size", "p_retailprice",
                         "p_type", "p_brand")
    return (t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                              "l_discount", "l_tax", "l_returnflag", "l_extendedprice")
            .join(part, "l_partkey"))


_LI = "lineitem l join part p on l.l_partkey = p.p_partkey"


@register("grid_search", """
select r.r as reg_param, e.e as elastic_net, true as scored, cast(1 as bigint) as n_chosen, true as optimal
from (values (cast(0.01 as double)), (0.1), (0.5)) r(r), (values (cast(0.0 as double)), (0.5), (1.0)) e(e)
where exists (select 1 from lineitem)""")
def q_grid_search(spark, sf):
    """3 x 3 grid of (regParam, elasticNet), validation split 0.8, R²: the grid
    points, each with a finite metric, exactly one of them chosen, and whether
    the model refitted there is the optimum of its objective."""
    df = _lineitem_regression_frame(spark, sf)
    data = FE.assemble(df.withColumnRenamed("l_extendedprice", "label"),
                       ["l_quantity", "p_retailprice", "l_discount", "l_tax"]).select("label", "features")
    lr = M.linear_regression()
    model = M.tune(lr, M.grid(lr, *MJ.PRICE_GRID), RegressionEvaluator(metricName="r2"), data, 0.8, 42)
    report = M.grid_report(spark, model, "r2")
    chosen = report.agg(F.count_if("chosen")).head()[0]
    return report.select("reg_param", "elastic_net", (F.col("r2") <= 1.0).alias("scored"),
                         F.lit(chosen).cast("long").alias("n_chosen"),
                         F.lit(_optimal(model.bestModel, data)).alias("optimal"))


#: A solver stops within this distance of its optimum (in standardised units); a model that is
#: no fit misses by about one over the square root of the rows, or more.
NEAR = 1e-4


def _optimal(model, data) -> bool:
    return M.optimality_gap(model, data) < NEAR


def _tuned_optimal(stages, train) -> bool:
    """The same for a stage list that ends in a tuned regression."""
    best = stages.stages[-1].bestModel
    for stage in stages.stages[:-1]:
        train = stage.transform(train)
    return _optimal(best, train.select("label", "features"))


def _finite(c: str):
    return F.col(c).isNotNull() & ~F.isnan(c)


@register("ml_stages", f"""
select l_orderkey, l_linenumber, l_extendedprice as label, true as scored from {_LI}
where {_point("l_orderkey", "l_linenumber")} >= 0.8""")
def q_ml_stages(spark, sf):
    """Indexers -> one-hot -> assembler -> tuned linear regression (3 x 3 grid,
    validation ratio 0.8), fitted as one stage list on a training split; every
    holdout row with its label and whether it got a prediction of an optimal fit."""
    df = _lineitem_regression_frame(spark, sf).withColumnRenamed("l_extendedprice", "label")
    train, holdout = FE.seeded_split(df, [0.8, 0.2], ["l_orderkey", "l_linenumber"], 42)
    stages = MJ._encoded_stages(["p_type", "l_returnflag"], ["l_quantity", "p_retailprice"])
    lr = M.linear_regression()
    tvs = M.TrainValidationSplit(estimator=lr, estimatorParamMaps=M.grid(lr, *MJ.PRICE_GRID),
                                 evaluator=RegressionEvaluator(metricName="r2"), trainRatio=0.8,
                                 seed=42, parallelism=4)
    model = M.fit_stages(stages + [tvs], train)
    scored = _finite("prediction") & F.lit(_tuned_optimal(model, train))
    return model.transform(holdout).select("l_orderkey", "l_linenumber", "label", scored.alias("scored"))


@register("logistic_regression", f"""
select d.doc_id, cast(l.quality as double) as label, true as scored
from documents d join labels l on d.doc_id = l.doc_id where {_point("d.doc_id")} >= 0.9""")
def q_logistic_regression(spark, sf):
    """Binary classifier on document features, tuned over regParam x elasticNet
    (6 x 3, validation ratio 0.9, area under ROC); every holdout row with its
    label and whether it got a probability of an optimal fit."""
    d = _labelled_docs(spark, sf)
    stages = MJ._encoded_stages(["lang"], ["n_chars"])
    prepared = M.fit_stages(stages, d).transform(d) \
        .select("doc_id", F.col("quality").cast("double").alias("label"), "features")
    train, holdout = FE.seeded_split(prepared, [0.9, 0.1], "doc_id", 42)
    lr = M.logistic_regression()
    tuned = M.tune(lr, M.grid(lr, *MJ.RETENTION_GRID),
                   BinaryClassificationEvaluator(metricName="areaUnderROC"), train, 0.9, 42)
    pred = tuned.bestModel.transform(holdout)
    scored = vector_to_array("probability").getItem(1).between(0.0, 1.0) & F.lit(_optimal(tuned.bestModel, train))
    return pred.select("doc_id", "label", scored.alias("scored"))


def _customer_frame(spark, sf):
    """Per customer: grouped nation, balance, order count, mean order value and
    a 0/1 label (has at least one urgent order)."""
    t = Tables(spark, sf)
    per_cust = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.avg("o_totalprice").alias("avg_order"),
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("n_urgent"))
    names = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    c = lookup(t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), names, "c_nationkey")
    c = c.withColumn("country", category_group("n_name", ("NATION_0", "NATION_1", "NATION_2"),
                                               {"EUROPE": ("NATION_3", "NATION_8", "NATION_13")}))
    out = c.join(per_cust, "c_custkey", "left").fillna(0, ["n_orders", "n_urgent"]) \
           .fillna(0.0, ["avg_order"])
    return out.withColumn("label", binary_label("n_urgent", 1, inclusive=True))


def _tree_data(spark, sf):
    c = _customer_frame(spark, sf)
    idx, _ = FE.index_strings(c, {"country": "country_index"})
    data = FE.assemble(idx, ["country_index", "c_acctbal", "n_orders", "avg_order"]) \
             .select("c_custkey", F.col("label").cast("double").alias("label"), "features")
    return FE.seeded_split(data, [0.8, 0.2], "c_custkey", 42)


_TREE_ORACLE = f"""
select c.c_custkey, cast(count(*) filter (where o.o_orderpriority = '1-URGENT') > 0 as int)::double as label,
       true as scored
from customer c left join orders o on o.o_custkey = c.c_custkey
where {_point("c.c_custkey")} >= 0.8 group by 1"""


def _beats_one_cut(model, train, orders_at: int) -> bool:
    """Whether the trees' probabilities on their training rows are nearer to the labels than those of
    one cut at the mean number of orders, the strongest feature."""
    cut = train.withColumn("n_orders", vector_to_array("features").getItem(orders_at))
    return M.brier_score(model.transform(train)) < M.one_cut_brier(cut, "n_orders")


def _class_given(model, train, holdout):
    """Each holdout row: whether it got the class that its probability says, of a model that learned."""
    sure = F.when(vector_to_array("probability").getItem(1) > 0.5, 1.0).otherwise(0.0)
    good = (F.col("prediction") == sure) & F.lit(_beats_one_cut(model, train, 2))
    return model.transform(holdout).select("c_custkey", "label", good.alias("scored"))


@register("decision_tree", _TREE_ORACLE)
def q_decision_tree(spark, sf):
    train, holdout = _tree_data(spark, sf)
    return _class_given(M.decision_tree(3).fit(train), train, holdout)


@register("random_forest", _TREE_ORACLE)
def q_random_forest(spark, sf):
    train, holdout = _tree_data(spark, sf)
    return _class_given(M.random_forest(6).fit(train), train, holdout)


def _embedding_vectors(spark, sf):
    e = Tables(spark, sf).embeddings.select("vec_id", "embedding")
    return FE.array_column_to_vector(e, "embedding", "features")


def _kmeans_fit(spark, sf):
    data = _embedding_vectors(spark, sf)
    return data, M.kmeans(5, seed=1).fit(data)


@register("kmeans", """
select count(*) as total, cast(least(5, count(*)) as bigint) as k, count(*) as n_nearest, true as closer from embeddings""")
def q_kmeans(spark, sf):
    """Rows assigned to a cluster, clusters that hold any, rows whose centre is the nearest one, and
    whether the centres are closer to the rows than the mean of all is."""
    data, model = _kmeans_fit(spark, sf)
    d = M.center_distances(model.transform(data), model)
    own, best = F.get("distances", F.col("prediction")), F.array_min("distances")
    return d.agg(F.count("prediction").alias("total"), F.count_distinct("prediction").alias("k"),
                 F.count_if(own <= best + 1e-9).alias("n_nearest"),
                 (F.sum(own) < M.total_squares(data)).alias("closer"))


@register("kmeans_centers", """
select cast(i as integer) as cluster, cast(max(len(embedding)) as integer) as dims, true as settled
from embeddings, range(5) r(i) group by i""")
def q_kmeans_centers(spark, sf):
    """The centres' sizes, and whether each is settled: moved to the mean of its rows, it would
    lower their squared distances by less than a tenth."""
    data, model = _kmeans_fit(spark, sf)
    d = M.center_distances(model.transform(data), model)
    means = d.groupBy(F.col("prediction").alias("cluster")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.get("distances", F.col("prediction"))).alias("cost"),
        vector_to_array(M.Summarizer.mean(F.col("features"))).alias("mean"))
    moved = F.aggregate(F.zip_with("mean", "center", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v)
    settled = F.coalesce(F.col("n") * moved <= 0.1 * F.col("cost") + 1e-9, F.lit(False))
    return M.centers_frame(spark, model).join(means, "cluster", "left").select(
        "cluster", F.size("center").alias("dims"), settled.alias("settled"))


@register("kmeans_cost", "select count(*) as n, cast(0 as double) as gap from embeddings")
def q_kmeans_cost(spark, sf):
    """Relative gap between the training cost and the SSE recomputed from the centres."""
    data, model = _kmeans_fit(spark, sf)
    pred = model.transform(data)
    sse = M.sse_from_centers(spark, pred, model).head()[0]
    cost = float(model.summary.trainingCost)
    return pred.agg(F.count(F.lit(1)).alias("n")).withColumn("gap", F.lit(abs(round((cost - sse) / sse, 6))))


@register("silhouette", """
select cast(count(*) as bigint) as n, cast(0 as double) as gap, true as better from embeddings""")
def q_silhouette(spark, sf):
    """The evaluator's silhouette of the fitted clusters: its gap to the value from per-cluster sums, and
    whether it is above that of the rows dealt to clusters by their id."""
    data, model = _kmeans_fit(spark, sf)
    pred = model.transform(data).withColumn("x", vector_to_array("features"))
    value = float(M.silhouette(pred))
    own = M.silhouette_from_sums(pred, "x", "prediction").head()
    dealt = M.silhouette_from_sums(pred.withColumn("dealt", F.col("vec_id") % 5), "x", "dealt").head()
    return pred.agg(F.count(F.lit(1)).alias("n")).select(
        "n", F.lit(abs(round(value - (own[0] or 0.0), 6))).alias("gap"), F.lit(value > (dealt[0] or 0.0)).alias("better"))


def _ratings(spark, sf):
    checkpoint_root(spark)      # ALS cuts its lineage every few iterations here
    t = Tables(spark, sf)
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"))
    j = t.lineitem.select("l_orderkey", F.col("l_partkey").alias("item_id"), "l_quantity").join(o, "l_orderkey")
    out = scratch_path(spark, "ratings")       # read by the id tables, the fit and the history
    remove_at_exit(spark, out)
    sums = j.groupBy("user_id", "item_id").agg(F.sum("l_quantity").alias("rating"))
    sums.write.parquet(out)
    return spark.read.schema(sums.schema).parquet(out)


_RATINGS = """r as (select o.o_custkey as user_id, l.l_partkey as item_id, sum(l.l_quantity) as rating
        from lineitem l join orders o on l.l_orderkey = o.o_orderkey group by 1, 2),
     w as (select distinct user_id from r where user_id % 50 = 0)"""


def _wanted(ratings):
    """The users to serve: a stated query set, here those whose id is divisible by 50."""
    return ratings.where(F.col("user_id") % 50 == 0).select("user_id").distinct()


def _recommended(ratings, wanted=None, k: int = 5):
    """(recommendations for the users in ``wanted`` or for all, whether the fit holds): its error on the
    ratings is below that of their mean, and every score is the product of the two factors."""
    fitted = M.rating_model(ratings, "user_id", "item_id", "rating")
    # searched once: the scores are checked and the rows returned from what was written
    recs = written(M.recommend(fitted, wanted, "user_id", "item_id", k), "recommended")
    rmse, spread = M.rating_errors(fitted, "rating")
    numbered = recs.join(fitted.users, "user_id").join(fitted.items, "item_id")
    return recs, rmse < spread and M.score_gap(fitted.model, numbered) < 1e-3


@register("als_recommend", f"""
with {_RATINGS}
select distinct user_id, cast(least(5, (select count(distinct item_id) from r)) as bigint) as n_items, true as fitted
from r where user_id is not null""")
def q_als_recommend(spark, sf):
    """Distinct known items recommended to every user, by a fit that holds."""
    recs, fits = _recommended(_ratings(spark, sf))
    return recs.groupBy("user_id").agg(F.count_distinct("item_id").alias("n_items")).withColumn("fitted", F.lit(fits))


@register("recs_with_history", f"""
with {_RATINGS}
select user_id, 'watched' as kind, item_id, rating as score from r join w using (user_id)
union all
select user_id, 'recommended', cast(null as bigint),
       cast(least(5, (select count(distinct item_id) from r)) as double) from w""")
def q_recs_with_history(spark, sf):
    """The query set's history, and beside it how many items each user is recommended by a fit that
    holds (the items themselves depend on the solver and are unit-tested)."""
    ratings = _ratings(spark, sf)
    recs, fits = _recommended(ratings, _wanted(ratings))
    both = M.recommendations_with_history(recs, ratings.join(_wanted(ratings), "user_id"), "user_id", "item_id")
    counts = both.where("kind = 'recommended'").groupBy("user_id", "kind").agg(
        F.lit(None).cast("bigint").alias("item_id"), F.count_if(F.lit(fits)).cast("double").alias("score"))
    return both.where("kind = 'watched'").unionByName(counts)


@register("house_price_model", f"""
select case when {_point("l_orderkey", "l_linenumber")} < 0.8 then 'train' else 'holdout' end as split,
       count(*) as n, true as fitted
from {_LI} group by 1""")
def q_house_price_model(spark, sf):
    """Rows of the two parts, each with R² and RMSE of an optimal fit."""
    df = _lineitem_regression_frame(spark, sf)
    fitted, train, holdout = MJ.house_price_fit(
        df, "l_extendedprice", numeric=["l_quantity", "l_discount", "l_tax", "p_size"],
        categorical=["p_type", "l_returnflag"], keys=["l_orderkey", "l_linenumber"],
        ratio=("p_retailprice", "p_size", "price_per_size"))
    report, _ = MJ.price_report(fitted, train, holdout)
    good = (F.col("r2") <= 1.0) & (F.col("rmse") >= 0.0) & F.lit(_tuned_optimal(fitted, train))
    return report.select("split", "n", good.alias("fitted"))


@register("retention_model", f"""
select cast(case when l.quality > 0 then 0 else 1 end as double) as label, count(*) as n, true as optimal
from documents d join labels l on d.doc_id = l.doc_id
where l.quality is not null and {_point("d.doc_id")} >= 0.9 group by 1""")
def q_retention_model(spark, sf):
    """The holdout's confusion table, summed to its rows per label, of an optimal fit."""
    t = Tables(spark, sf)
    docs = t.documents.select("doc_id", "n_chars", "lang", "source")
    df = docs.join(t.labels, "doc_id", "left")
    model, train, holdout = MJ.retention_fit(df, "quality", numeric=["n_chars", "toxic"],
                                             categorical=["lang", "source"], keys="doc_id",
                                             keep=F.col("quality").isNotNull(), fill_zero=["toxic"])
    table = M.confusion_table(model.transform(holdout))
    return table.groupBy("label").agg(F.sum("count").alias("n")).withColumn("optimal", F.lit(_optimal(model, train)))


@register("trial_conversion_trees", f"""
with h as ({_TREE_ORACLE})
select m as model, count(*) as n, true as learned from (values ('decision_tree'), ('random_forest')) t(m), h group by 1""")
def q_trial_conversion_trees(spark, sf):
    """Holdout rows that the two models classified, and whether each learned more than one cut."""
    c = _customer_frame(spark, sf)
    tree, forest, train, holdout = MJ.trial_conversion_fit(c, "country", ["c_acctbal", "n_orders", "avg_order"], "c_custkey")
    parts = [m.transform(holdout).agg(F.lit(name).alias("model"), F.count_if(F.col("prediction").isin(0.0, 1.0)).alias("n"))
             .withColumn("learned", F.lit(_beats_one_cut(m, train, 2)))
             for name, m in (("decision_tree", tree), ("random_forest", forest))]
    return parts[0].unionByName(parts[1])


@register("views_forecast", f"""
select o_orderkey, coalesce(o_totalprice, 0) as label, true as scored from orders
where {_point("o_orderkey")} >= 0.9""")
def q_views_forecast(spark, sf):
    """The course-views forecast: null fill, encode, 6 x 3 grid; the holdout rows scored by an optimal fit."""
    o = Tables(spark, sf).orders.select(
        "o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority",
        F.month("o_orderdate").alias("month"), F.year("o_orderdate").alias("year"))
    model, train, holdout = MJ.views_forecast_fit(o, "o_totalprice", ["month", "year"],
                                                  ["o_orderstatus", "o_orderpriority"], "o_orderkey")
    scored = _finite("prediction") & F.lit(_tuned_optimal(model, train))
    return model.transform(holdout).select("o_orderkey", "label", scored.alias("scored"))


@register("clustering_report", """
select count(*) as total, true as cost_holds, true as closer, true as apart from part""")
def q_clustering_report(spark, sf):
    """Encode, assemble, fit, sizes, cost and silhouette in one job: the sizes add up, the cost is
    that of the centres (Spark states it before the last move of the centres, which lowers it a
    little), below that of the mean, and the clusters lie apart."""
    p = Tables(spark, sf).part
    model, rows = MJ.clustering_fit(p, ["p_size", "p_retailprice"], ["p_type"])
    report = MJ.cluster_sizes(model, rows)
    sse = M.center_distances(rows, model).agg(F.sum(F.array_min("distances"))).head()[0] or 0.0
    holds = F.max("cost").between(sse * (1 - 1e-6), sse * 1.02 + 1e-6)
    return report.agg(F.sum("size").alias("total"), holds.alias("cost_holds"),
                      (F.max("cost") < M.total_squares(rows)).alias("closer"),
                      (F.max("silhouette") > 0).alias("apart"))


@register("ols_report", f"""
select * from (values (0, {half_up("(select regr_intercept(l_extendedprice, l_quantity) from lineitem)", 4)}),
                      (1, {half_up("(select regr_slope(l_extendedprice, l_quantity) from lineitem)", 4)}))
       t(position, coefficient)""")
def q_ols_report(spark, sf):
    """Ordinary least squares as one stage list: intercept and coefficients."""
    li = Tables(spark, sf).lineitem.select("l_extendedprice", "l_quantity")
    report = MJ.ols_report(spark, li, "l_extendedprice", ["l_quantity"], [])
    return report.select("position", F.round("coefficient", 4).alias("coefficient"))


# ---- forms for large inputs: shared statistics, unbounded columns, all users ----------------

_GRID = "(values (cast(0.01 as double)), (0.1), (0.5)) r(r), (values (cast(0.0 as double)), (0.5), (1.0)) e(e)"


@register("grid_from_statistics", f"""
with t as (select l_extendedprice as y, l_quantity as x, {_point("l_orderkey", "l_linenumber")} < 0.8 as train from lineitem),
     a as (select count(*) as n, avg(x) as mx, avg(y) as my, stddev_samp(x) as sx, stddev_samp(y) as sy, corr(x, y) as rho
           from t where train),
     g as (select r, e, mx, my, rho * (n - 1) / n as c, (n - 1) / n as d, sy / sx as scale, r / sy * e as l1, r / sy * (1 - e) as l2
           from a, {_GRID}),
     w as (select r, e, mx, my, sign(c) * greatest(abs(c) - l1, 0) / (d + l2) * scale as w from g),
     v as (select y, x, avg(y) over () as m from t where not train),
     s as (select r, e, 1 - sum(power(y - (my - w * mx) - w * x, 2)) / sum(power(y - m, 2)) as r2 from v, w group by r, e)
select r as reg_param, e as elastic_net, {half_up("r2", 6)} as r2 from s""")
def q_grid_from_statistics(spark, sf):
    """The 3 x 3 grid on one scan: moments per fold, every point solved and scored from them."""
    li = Tables(spark, sf).lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    folds = li.withColumn("fold", F.when(F.expr(_point("l_orderkey", "l_linenumber")) < 0.8, 0).otherwise(1))
    report = TU.grid_from_moments(folds, ["l_quantity"], "l_extendedprice", "fold", *MJ.PRICE_GRID)
    return report.select("reg_param", "elastic_net", F.round("r2", 6).alias("r2"))


@register("string_index_ranked", _PRIORITY_RANK + """
select o.o_orderkey, r.idx as priority_index from orders o join r on o.o_orderpriority = r.v""")
def q_string_index_ranked(spark, sf):
    """String index of a column with any number of values: ranks by range, no label list on the driver."""
    o = Tables(spark, sf).orders.select("o_orderkey", "o_orderpriority")
    return FE.index_by_frequency(o, "o_orderpriority", "priority_index").select("o_orderkey", "priority_index")


@register("silhouette_from_sums", f"""
with p as (select vec_id, vec_id % 5 as c, embedding as x from embeddings where embedding is not null),
     q as (select c, count(*) as n, sum(list_dot_product(x::double[], x::double[])) as q from p group by c),
     e as (select c, unnest(range(1, len(x) + 1)) as i, unnest(x) as v from p),
     y as (select c, list(s order by i) as y from (select c, i, sum(cast(v as double)) as s from e group by c, i) group by c),
     m as (select p.vec_id, p.c = q.c as own, q.n,
                  (q.n * list_dot_product(p.x::double[], p.x::double[]) + q.q - 2 * list_dot_product(p.x::double[], y.y))
                  / case when p.c = q.c then greatest(q.n - 1, 1) else q.n end as mean
           from p, q join y on y.c = q.c),
     s as (select vec_id, max(n) filter (own) as n, max(mean) filter (own) as a, min(mean) filter (not own) as b from m group by 1)
select {half_up("avg(case when n = 1 then 0 else (b - a) / greatest(a, b) end)", 6)} as silhouette, count(*) as n from s""")
def q_silhouette_from_sums(spark, sf):
    """Silhouette of a given assignment (vec_id % 5), from per-cluster sums."""
    e = Tables(spark, sf).embeddings.where("embedding is not null").withColumn("cluster", F.col("vec_id") % 5)
    return M.silhouette_from_sums(e, "embedding", "cluster").select(F.round("silhouette", 6).alias("silhouette"), "n")


@register("recommend_all_users", f"""
with {_RATINGS}
select distinct user_id, cast(least(5, (select count(distinct item_id) from r)) as bigint) as n_items, true as exact from r""")
def q_recommend_all_users(spark, sf):
    """Five best items of every user by the length-bounded search; ``exact``: its scores descend and, for
    users whose id is divisible by 50, are those of the model's own search over all items."""
    model, users, _, _ = M.rating_model(_ratings(spark, sf), "user_id", "item_id", "rating")
    best = RC.top_items_for_all(model.userFactors, model.itemFactors, 5)
    asked = users.where(F.col("user_id") % 50 == 0)
    own = M.top_items_for_users(model, asked, "user_no", "item_no", 5).select(
        F.col("user_no").alias("id"), "rank", F.col("score").alias("own"))
    both = best.join(own, ["id", "rank"], "left").groupBy("id").agg(
        F.count_distinct("item").alias("n_items"), F.max(F.abs(F.col("score") - F.col("own"))).alias("gap"),
        F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("s"))
    falls = F.forall(F.zip_with("s", F.slice("s", 2, 4), lambda a, b: F.coalesce(a["score"] >= b["score"], F.lit(True))),
                     lambda x: x)
    exact = falls & (F.coalesce("gap", F.lit(0.0)) < 1e-4)
    return both.join(users, both["id"] == users["user_no"]).select("user_id", "n_items", exact.alias("exact"))
