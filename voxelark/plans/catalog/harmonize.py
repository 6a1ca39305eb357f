"""Batch-effect harmonization."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from voxelark.functions.sizing import attach, shared_dir
from voxelark.operators.combat import (
    CombatModel,
    attach_batch,
    combat,
    combat_external,
    fit_combat,
    standardized_long,
)
from voxelark.operators.predict import LinearScorer
from voxelark.plans.catalog.common import load, rounded, sql_round
from voxelark.plans.pipeline import Pipeline, Step
from voxelark.streaming.arrivals import read_arrivals, score_stream

ID = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"]
NAMES = ["l_quantity", "price", "l_discount", "l_tax"]
CUT = "1998-01-01"
WIDE = [f"e{i:02d}" for i in range(64)]
WEIGHTS = {"l_quantity": 1.0, "price": -2.0, "l_tax": 0.5}


def _items(spark, sf_dir):
    """Line items with their supplier's nation as batch."""
    line = load(spark, sf_dir, "lineitem").withColumn("price", F.col("l_extendedprice") / 10000)
    supplier = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("batch"))
    batches = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    # Spark guesses the size of a join by multiplying, and would shuffle all line items to a few suppliers.
    batches = batches.select(F.col("s_suppkey").alias("l_suppkey"), "batch")
    return attach(line, batches, ["l_suppkey"], "inner", "supplier-batches").select(
        *ID, "l_shipdate", "batch", "l_linestatus", "l_returnflag", *NAMES
    )


def _vectors(spark, sf_dir):
    return load(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.col("label").cast("string").alias("batch"),
        *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(WIDE)],
    )


def _harmonized_items(**options):
    def run(spark, sf_dir):
        df = _items(spark, sf_dir)
        model = fit_combat(df, NAMES, **options)
        return rounded(model.transform(df).select(*ID, *NAMES))

    return run


def _harmonized_vectors(**options):
    def run(spark, sf_dir):
        df = _vectors(spark, sf_dir)
        return rounded(fit_combat(df, WIDE, **options).transform(df).drop("batch"))

    return run


def combat_estimates(spark, sf_dir):
    """Location, scale and shrunken estimates per feature and batch."""
    model = fit_combat(_vectors(spark, sf_dir), WIDE)
    return rounded(model.feature_batches)


def combat_batch_priors(spark, sf_dir):
    model = fit_combat(_vectors(spark, sf_dir), WIDE)
    return rounded(model.batches)


def combat_feature_estimates(spark, sf_dir):
    model = fit_combat(_items(spark, sf_dir), NAMES, covars=["l_returnflag"])
    return rounded(
        model.features.select(
            "feature", "stand_mean", "var_pooled", "mod_mean",
            F.col("betas")["l_returnflag=N"].alias("beta_n"),
            F.col("betas")["l_returnflag=R"].alias("beta_r"),
        )
    )


def combat_standardized(spark, sf_dir):
    df = _items(spark, sf_dir)
    return rounded(standardized_long(df, fit_combat(df, NAMES), ID))


def combat_absorbed_covariate(spark, sf_dir):
    """Two batches and a covariate of three levels, which are eliminated instead of being model columns."""
    df = _items(spark, sf_dir)
    model = fit_combat(df, NAMES, "l_linestatus", covars=["l_returnflag"], dense_terms=0)
    return rounded(model.transform(df).select(*ID, *NAMES))


def combat_study(spark, sf_dir):
    """Whole study: duplicate keys dropped, batch table joined and checked, harmonized."""
    df = _items(spark, sf_dir)
    keys = ["l_orderkey", "l_linenumber"]
    features = df.select(*keys, "l_suppkey", "l_partkey", *NAMES)
    batches = df.select(*keys, "l_linestatus")
    return rounded(
        combat(features, batches, keys, "l_linestatus", names=NAMES, order_by=["l_suppkey", "l_partkey"])
    )


def _external(ref):
    def run(spark, sf_dir):
        df = _items(spark, sf_dir)
        train, new = df.filter(F.col("l_shipdate") < CUT), df.filter(F.col("l_shipdate") >= CUT)
        return rounded(
            combat_external(
                train.select(*ID, *NAMES), train.select(*ID, "l_linestatus"),
                new.select(*ID, *NAMES), new.select(*ID, "l_linestatus"),
                ID, "l_linestatus", ref_batch=ref, names=NAMES,
            )
        )

    return run


def combat_trained_estimates(spark, sf_dir):
    """Estimates fitted on earlier shipments applied to later ones."""
    df = _items(spark, sf_dir)
    model = fit_combat(df.filter(F.col("l_shipdate") < CUT), NAMES, covars=["l_returnflag"])
    return rounded(model.apply_trained(df.filter(F.col("l_shipdate") >= CUT)).select(*ID, *NAMES))


def combat_saved_estimates(spark, sf_dir):
    """Estimates written, read back, and applied to the same vectors."""
    df = _vectors(spark, sf_dir)
    path = f"{shared_dir(spark)}/voxelark/combat-{uuid.uuid4().hex}"
    fit_combat(df, WIDE).save(path)
    return rounded(CombatModel.load(spark, path).transform(df).drop("batch"))


def harmonized_chain_replayed(spark, sf_dir):
    """Harmonize, then normalize: both follow the training table on new data."""
    df = _items(spark, sf_dir)
    columns = [*ID, "l_returnflag", *NAMES]
    train, new = df.filter(F.col("l_shipdate") < CUT), df.filter(F.col("l_shipdate") >= CUT)
    steps = [
        Step("harmonize", {"batch": train.select(*ID, "l_linestatus"), "batch_col": "l_linestatus",
                           "names": NAMES, "ref_batch": "F"}),
        Step("normalize", {"features": NAMES, "method": "minmax", "by": "l_returnflag"}),
    ]
    bundle, _ = Pipeline(steps, {"keys": ID}).fit(train.select(*columns))
    overrides = {"harmonize": {"batch": new.select(*ID, "l_linestatus")}}
    return rounded(bundle.transform(new.select(*columns), overrides))


def _monthly_items(spark, sf_dir):
    """Line items with their month of shipment as a continuous covariate."""
    return _items(spark, sf_dir).withColumn("month", F.month("l_shipdate"))


def combat_continuous(spark, sf_dir):
    df = _monthly_items(spark, sf_dir)
    batches = df.select(*ID, "month", "l_linestatus")
    return rounded(combat(df.select(*ID, *NAMES), batches, ID, "l_linestatus", names=NAMES, continuous=["month"]))


def combat_external_continuous(spark, sf_dir):
    df = _monthly_items(spark, sf_dir)
    train, new = df.filter(F.col("l_shipdate") < CUT), df.filter(F.col("l_shipdate") >= CUT)
    batches = [*ID, "month", "l_linestatus"]
    return rounded(
        combat_external(
            train.select(*ID, *NAMES), train.select(*batches), new.select(*ID, *NAMES), new.select(*batches),
            ID, "l_linestatus", ref_batch="F", names=NAMES, continuous=["month"],
        )
    )


def scored_stream_harmonized(spark, sf_dir):
    """Later shipments arrive as a stream: harmonized towards the earlier ones, normalized, scored."""
    df = _items(spark, sf_dir)
    columns = [*ID, "l_returnflag", *NAMES]
    train, new = df.filter(F.col("l_shipdate") < CUT), df.filter(F.col("l_shipdate") >= CUT)
    steps = [
        Step("harmonize", {"batch": train.select(*ID, "l_linestatus"), "batch_col": "l_linestatus",
                           "names": NAMES, "ref_batch": "F"}),
        Step("normalize", {"features": NAMES, "method": "minmax", "by": "l_returnflag"}),
    ]
    bundle, _ = Pipeline(steps, {"keys": ID}).fit(train.select(*columns))
    arriving = read_arrivals(spark, sf_dir, load(spark, sf_dir, "lineitem").schema, glob="lineitem.parquet")
    arriving = arriving.filter(F.col("l_shipdate") >= CUT).withColumn("price", F.col("l_extendedprice") / 10000)
    where = f"{shared_dir(spark)}/voxelark/stream-{uuid.uuid4().hex}"
    score_stream(
        arriving.select(*columns), bundle, f"{where}/out", f"{where}/checkpoint",
        overrides={"harmonize": {"batch": new.select(*ID, "l_linestatus")}},
        then=[Step("predict", {"model": LinearScorer(list(WEIGHTS), list(WEIGHTS.values()), 1.0)})],
    ).awaitTermination()
    return rounded(spark.read.parquet(f"{where}/out").select(*ID, "predictions"))


def batches_attached(spark, sf_dir):
    df = _items(spark, sf_dir)
    suppliers = df.select("l_suppkey", "batch").distinct()
    features = load(spark, sf_dir, "lineitem").select(*ID, "l_quantity")
    return attach_batch(features, suppliers, ["batch"], ["l_suppkey"])


QUERIES = {
    "batches_attached": batches_attached,
    "combat_saved_estimates": combat_saved_estimates,
    "harmonized_chain_replayed": harmonized_chain_replayed,
    "scored_stream_harmonized": scored_stream_harmonized,
    "combat_continuous": combat_continuous,
    "combat_external_continuous": combat_external_continuous,
    "combat_parametric": _harmonized_items(),
    "combat_no_shrinkage": _harmonized_items(eb=False),
    "combat_mean_only": _harmonized_items(mean_only=True),
    "combat_non_parametric": _harmonized_vectors(parametric=False),
    "combat_reference_batch": _harmonized_items(ref_batch="NATION_3"),
    "combat_covariate": _harmonized_items(covars=["l_returnflag"]),
    "combat_covariate_reference": _harmonized_items(covars=["l_returnflag"], ref_batch="NATION_3"),
    "combat_many_features": _harmonized_vectors(),
    "combat_estimates": combat_estimates,
    "combat_batch_priors": combat_batch_priors,
    "combat_feature_estimates": combat_feature_estimates,
    "combat_standardized": combat_standardized,
    "combat_solved_covariate": _harmonized_items(covars=["l_returnflag"], dense_terms=0),
    "combat_absorbed_covariate": combat_absorbed_covariate,
    "combat_study": combat_study,
    "combat_external": _external("F"),
    "combat_external_pooled": _external(None),
    "combat_trained_estimates": combat_trained_estimates,
}

# ---------------------------------------------------------------- checking SQL

_ITEMS = """SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_shipdate, n_name AS batch,
 l_linestatus, l_returnflag AS cov, l_quantity, l_extendedprice / 10000 AS price, l_discount, l_tax
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey"""
_VECTORS = "SELECT vec_id, CAST(label AS VARCHAR) AS batch, 'x' AS cov, " + ", ".join(
    f"CAST(embedding[{i + 1}] AS DOUBLE) AS {n}" for i, n in enumerate(WIDE)
) + " FROM embeddings"


# Values of the two model columns: dummies of a flag, or one number.
_Z = {
    "levels": ("CASE cov WHEN 'N' THEN 1.0 ELSE 0.0 END", "CASE cov WHEN 'R' THEN 1.0 ELSE 0.0 END"),
    "continuous": ("CAST(CAST(cov AS FLOAT) AS DOUBLE)", "0.0"),
}


def _steps(base, ids, names, ref=None, covariate=False, mode="parametric", train="TRUE"):
    """Common table expressions of the method, written out over the samples."""
    keys = ", ".join(ids)
    long = " UNION ALL ".join(
        f"SELECT {keys}, batch, cov, {train} AS fit, '{f}' AS feature, {f} AS y FROM base" for f in names
    )
    is_ref = f"batch = '{ref}'" if ref else "TRUE"
    grand = f"max(CASE WHEN {is_ref} THEN b END)" if ref else "sum(n * b) / sum(n)"
    beta = {
        False: "0.0 AS b1, 0.0 AS b2",
        True: """(s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
           (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2""",
        "continuous": "s1y / s11 AS b1, 0.0 AS b2",
    }[covariate]
    z1, z2 = _Z["continuous" if covariate == "continuous" else "levels"]
    stars = {
        "none": "SELECT feature, batch, gh AS gs, dh AS ds FROM est",
        "mean": "SELECT feature, batch, (t2 * gh + gbar) / (t2 + 1) AS gs, 1.0 AS ds FROM est JOIN pri USING (batch)",
        "nonparametric": """SELECT feature, batch, sum(g * w) / sum(w) AS gs, sum(d * w) / sum(w) AS ds FROM (
            SELECT feature, batch, g, d, exp(lw - max(lw) OVER (PARTITION BY feature, batch)) AS w FROM (
              SELECT a.feature, a.batch, o.gh AS g, o.dh AS d,
                -a.n / 2.0 * ln(2 * pi() * o.dh) - (a.q2 - 2 * o.gh * a.q1 + a.n * o.gh * o.gh) / (2 * o.dh) AS lw
              FROM est a JOIN est o ON a.batch = o.batch AND a.feature <> o.feature)) GROUP BY 1, 2""",
        "parametric": "SELECT feature, batch, arg_max(g, r) AS gs, arg_max(d, r) AS ds FROM it GROUP BY 1, 2",
    }[mode]
    iterate = """it AS (
  SELECT 0 AS r, feature, batch, gh AS g, dh AS d, CAST(1 AS DOUBLE) AS change FROM est WHERE NOT isref
  UNION ALL
  SELECT r + 1, feature, batch, gn, dn,
    greatest(max(abs(gn - g) / g) OVER (PARTITION BY batch), max(abs(dn - d) / d) OVER (PARTITION BY batch))
  FROM (SELECT r, feature, batch, g, d, gn,
          (0.5 * (q2 - 2 * gn * q1 + n * gn * gn) + bp) / (n / 2.0 + ap - 1) AS dn
        FROM (SELECT it.r, it.feature, it.batch, it.g, it.d, e.q1, e.q2, e.n, p.ap, p.bp,
                (p.t2 * e.n * e.gh + it.d * p.gbar) / (p.t2 * e.n + it.d) AS gn
              FROM it JOIN est e ON e.feature = it.feature AND e.batch = it.batch
              JOIN pri p ON p.batch = it.batch WHERE it.change > 1e-4))),
""" if mode == "parametric" else ""
    dh = "1.0" if mode == "mean" else "coalesce(nullif(var_samp(s), 0), 1)"
    return f"""WITH RECURSIVE base AS ({base}), long AS ({long}),
tr AS (SELECT *, {z1} AS z1, {z2} AS z2 FROM long WHERE fit),
cen AS (SELECT *, z1 - avg(z1) OVER w AS c1, z2 - avg(z2) OVER w AS c2, y - avg(y) OVER w AS cy
  FROM tr WINDOW w AS (PARTITION BY feature, batch)),
cross_products AS (SELECT feature, sum(c1 * c1) AS s11, sum(c1 * c2) AS s12, sum(c2 * c2) AS s22,
  sum(c1 * cy) AS s1y, sum(c2 * cy) AS s2y FROM cen GROUP BY 1),
beta AS (SELECT feature, {beta} FROM cross_products),
lvl AS (SELECT feature, batch, count(*) AS n, avg(y - b1 * z1 - b2 * z2) AS b
  FROM tr JOIN beta USING (feature) GROUP BY 1, 2),
gm AS (SELECT feature, {grand} AS grand FROM lvl GROUP BY 1),
vp AS (SELECT feature, avg((y - b1 * z1 - b2 * z2 - b) ** 2) AS v, avg(b1 * z1 + b2 * z2) AS modavg_ref
  FROM tr JOIN beta USING (feature) JOIN lvl USING (feature, batch) WHERE {is_ref} GROUP BY 1),
ma AS (SELECT feature, avg(b1 * z1 + b2 * z2) AS modavg FROM tr JOIN beta USING (feature) GROUP BY 1),
st AS (SELECT tr.*, (y - grand - b1 * z1 - b2 * z2) / sqrt(v) AS s
  FROM tr JOIN beta USING (feature) JOIN gm USING (feature) JOIN vp USING (feature)),
est AS (SELECT feature, batch, {f"batch = '{ref}'" if ref else 'FALSE'} AS isref, count(*) AS n,
  avg(s) AS gh, {dh} AS dh, sum(s) AS q1, sum(s * s) AS q2 FROM st GROUP BY 1, 2),
pri AS (SELECT batch, max(n) AS n, avg(gh) AS gbar, var_samp(gh) AS t2,
  (2 * var_samp(dh) + avg(dh) ** 2) / nullif(var_samp(dh), 0) AS ap,
  (avg(dh) * var_samp(dh) + avg(dh) ** 3) / nullif(var_samp(dh), 0) AS bp FROM est GROUP BY 1),
{iterate}stars AS (SELECT feature, batch, CASE WHEN isref THEN 0.0 ELSE gs END AS gs,
  CASE WHEN isref THEN 1.0 ELSE ds END AS ds FROM est LEFT JOIN ({stars}) x USING (feature, batch))"""


def _data_sql(base, ids, names, ref=None, covariate=False, mode="parametric", train="TRUE",
              where="TRUE", average=False, rounding=True):
    z1, z2 = _Z["continuous" if covariate == "continuous" else "levels"]
    mod = "modavg" if average else f"b1 * {z1} + b2 * {z2}"
    keep = f"CASE WHEN batch = '{ref}' THEN y ELSE " if ref else ""
    end = " END" if ref else ""
    keys = ", ".join(ids)
    return _steps(base, ids, names, ref, covariate, mode, train) + f""",
res AS (SELECT {keys}, feature, {keep}((y - grand - ({mod})) / sqrt(v) - gs) / sqrt(ds) * sqrt(v)
   + grand + ({mod}){end} AS h
  FROM long JOIN beta USING (feature) JOIN gm USING (feature) JOIN vp USING (feature) JOIN ma USING (feature)
  JOIN stars USING (feature, batch) WHERE {where})
SELECT {keys}, """ + ", ".join(
        (sql_round if rounding else str)(f"max(CASE WHEN feature = '{f}' THEN h END)") + f" AS {f}" for f in names
    ) + f" FROM res GROUP BY {keys}"


_LINESTATUS = _ITEMS.replace("n_name AS batch", "l_linestatus AS batch").replace(" l_linestatus,", "")
_STUDY = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
 ORDER BY l_suppkey, l_partkey, l_quantity, price, l_discount, l_tax) AS rn FROM ({_ITEMS.replace(', l_linestatus', '')
 .replace('n_name AS batch', 'min(l_linestatus) OVER (PARTITION BY l_orderkey, l_linenumber) AS batch')
 .replace(' l_linestatus,', '')})) WHERE rn = 1"""
_EXTERNAL = f"""SELECT * REPLACE (CASE WHEN l_shipdate < '{CUT}' THEN {{name}} ELSE batch END AS batch),
 l_shipdate >= '{CUT}' AS is_new FROM ({_LINESTATUS})"""


def _monthly(sql):
    return sql.replace("l_returnflag AS cov", "month(CAST(l_shipdate AS DATE)) AS cov")


def _external_sql(name, ref, base=_EXTERNAL, **options):
    ids = [*ID, "is_new"]
    sql = _data_sql(base.format(name=name), ids, NAMES, ref, where="is_new", **options)
    return f"SELECT * EXCLUDE (is_new) FROM ({sql})"


_TRAINED = _data_sql(f"SELECT * FROM ({_LINESTATUS}) WHERE l_shipdate < '{CUT}'", ID, NAMES, "F", rounding=False)
_CHAIN = f"""WITH tr AS ({_TRAINED}), nw AS ({_external_sql("batch || '_ref'", "F_ref", rounding=False)}),
flag AS (SELECT {', '.join(ID)}, l_returnflag FROM lineitem),
lim AS (SELECT l_returnflag, {', '.join(f'min({f}) AS lo_{f}, max({f}) AS hi_{f}' for f in NAMES)}
  FROM tr JOIN flag USING ({', '.join(ID)}) GROUP BY 1),
unit AS (SELECT {', '.join(ID)}, l_returnflag, {', '.join(
    f'({f} - lo_{f}) / nullif(hi_{f} - lo_{f}, 0) AS {f}' for f in NAMES)}
FROM nw JOIN flag USING ({', '.join(ID)}) JOIN lim USING (l_returnflag))
"""

ORACLES = {
    "batches_attached": f"""SELECT {', '.join(ID)}, l_quantity, n_name AS batch FROM lineitem
 JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey""",
    "combat_saved_estimates": _data_sql(_VECTORS, ["vec_id"], WIDE),
    "harmonized_chain_replayed": f"""{_CHAIN} SELECT {', '.join(ID)}, l_returnflag,
 {', '.join(sql_round(f) + f' AS {f}' for f in NAMES)} FROM unit""",
    "scored_stream_harmonized": f"""{_CHAIN} SELECT {', '.join(ID)},
 {sql_round('1.0 + ' + ' + '.join(f'{w} * {f}' for f, w in WEIGHTS.items()))} AS predictions FROM unit""",
    "combat_continuous": _data_sql(_monthly(_LINESTATUS), ID, NAMES, covariate="continuous"),
    "combat_external_continuous": _external_sql(
        "batch || '_ref'", "F_ref", _monthly(_EXTERNAL), covariate="continuous"
    ),
    "combat_parametric": _data_sql(_ITEMS, ID, NAMES),
    "combat_no_shrinkage": _data_sql(_ITEMS, ID, NAMES, mode="none"),
    "combat_mean_only": _data_sql(_ITEMS, ID, NAMES, mode="mean"),
    "combat_non_parametric": _data_sql(_VECTORS, ["vec_id"], WIDE, mode="nonparametric"),
    "combat_reference_batch": _data_sql(_ITEMS, ID, NAMES, ref="NATION_3"),
    "combat_covariate": _data_sql(_ITEMS, ID, NAMES, covariate=True),
    "combat_covariate_reference": _data_sql(_ITEMS, ID, NAMES, ref="NATION_3", covariate=True),
    "combat_many_features": _data_sql(_VECTORS, ["vec_id"], WIDE),
    "combat_estimates": _steps(_VECTORS, ["vec_id"], WIDE)
    + f""" SELECT feature, batch, {sql_round('gh')} AS gamma_hat, {sql_round('dh')} AS delta_hat,
 {sql_round('gs')} AS gamma_star, {sql_round('ds')} AS delta_star FROM est JOIN stars USING (feature, batch)""",
    "combat_batch_priors": _steps(_VECTORS, ["vec_id"], WIDE)
    + f""" SELECT batch, n, {sql_round('gbar')} AS gamma_bar, {sql_round('t2')} AS t2,
 {sql_round('ap')} AS a_prior, {sql_round('bp')} AS b_prior FROM pri""",
    "combat_feature_estimates": _steps(_ITEMS, ID, NAMES, covariate=True)
    + f""" SELECT feature, {sql_round('grand')} AS stand_mean, {sql_round('v')} AS var_pooled,
 {sql_round('modavg')} AS mod_mean, {sql_round('b1')} AS beta_n, {sql_round('b2')} AS beta_r
 FROM gm JOIN vp USING (feature) JOIN ma USING (feature) JOIN beta USING (feature)""",
    "combat_standardized": _steps(_ITEMS, ID, NAMES)
    + f" SELECT {', '.join(ID)}, feature, {sql_round('s')} AS value FROM st",
    "combat_solved_covariate": _data_sql(_ITEMS, ID, NAMES, covariate=True),
    "combat_absorbed_covariate": _data_sql(_LINESTATUS, ID, NAMES, covariate=True),
    "combat_study": _data_sql(_STUDY, ID, NAMES),
    "combat_external": _external_sql("batch || '_ref'", "F_ref"),
    "combat_external_pooled": _external_sql("'ref'", "ref"),
    "combat_trained_estimates": _data_sql(
        _ITEMS, [*ID, "l_shipdate"], NAMES, covariate=True, train=f"l_shipdate < '{CUT}'",
        where=f"l_shipdate >= '{CUT}'", average=True,
    ).replace("SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_shipdate, round",
              "SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, round"),
}
