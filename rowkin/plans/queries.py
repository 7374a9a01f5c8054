"""One query for each operator, over whole tables, and the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import BASE_COLUMNS, EXTRA_COLUMNS, KEY_CAPS, MODEL_COLUMNS, REFERENCE_COLUMNS, SCREEN_COLUMNS, SOURCE_COLUMNS
from ..functions import normalize, similarity
from ..operators import blocking, diagnose, evaluate, features, sampling, validate
from ..sources import sinks, tables
from ..sources.shared import shared_dir
from . import linkage, sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
NAME_KEYS, TOKEN_KEYS, PAIR_KEYS, ADDRESS_KEYS, NUMBER_KEYS = "ncspqmf", "tw", "jk", "ahbe", "dvx"


def query(oracle: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLE_SQL[f.__name__] = oracle
        return f

    return add


def records(spark: SparkSession, d: str) -> DataFrame:
    """Normalized records of the parties, from their cache: made when the tables have changed, read by every query after."""
    inputs = [f"{d}/{t}.parquet" for t in ("region", "nation", "customer", "supplier")]
    return tables.normalized(tables.parties(spark, d), inputs, f"{shared_dir(spark)}/parties")


def document_pairs(spark: SparkSession, d: str) -> DataFrame:
    made = tables.normalized(tables.document_parties(spark, d), [f"{d}/documents.parquet"], f"{shared_dir(spark)}/document-parties")
    one, rest = made.where("source = 1"), made.where("source != 1")
    return blocking.paired(blocking.candidates(one, rest), one, rest)


def split(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    made = records(spark, d)
    return made.where("source = 1"), made.where("source != 1")


def pairs(spark: SparkSession, d: str) -> DataFrame:
    one, rest = split(spark, d)
    return blocking.paired(blocking.candidates(one, rest), one, rest)


def class_pairs(spark: SparkSession, d: str) -> DataFrame:
    """``pairs`` of classes of like records, dealt out to be scored; ``by_record`` makes pairs of records of them."""
    found = linkage.alike(linkage.Records(*split(spark, d)))
    return features.spread(blocking.paired(blocking.candidates(found.references, found.sources), found.references, found.sources))


def by_record(pairs: DataFrame, made: list[Column]) -> DataFrame:
    """anchor, candidate and ``made`` (rounded) of every pair of records of ``pairs`` of classes."""
    return blocking.expanded(rounded(pairs.select(F.col("x.members").alias("_x"), F.col("y.members").alias("_y"), *made)))


def truth(spark: SparkSession, d: str) -> DataFrame:
    return sampling.exploded_truth(tables.party_truth(spark, d))


def anchors(spark: SparkSession, d: str) -> DataFrame:
    return split(spark, d)[0].select(F.col("entity_id").alias("anchor"), "country", F.lit(1).alias("true"))


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Pairs with a score that needs no model: the overlap of core words; screen: that of address words."""
    over = lambda f: F.round(features.overlap(normalize.tokens(F.col(f"x.{f}")), normalize.tokens(F.col(f"y.{f}"))), 6)
    made = pairs(spark, d).select("anchor", "candidate", F.lit(1).alias("retrieved"), over("core").alias("score"), over("address").alias("screen"))
    return sampling.labelled(made, truth(spark, d))


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query(f"""WITH {sql.SCORED}, sized AS (SELECT anchor, string_agg(candidate, ',' ORDER BY candidate) AS matched_entity_ids FROM scored WHERE score >= 0.5 GROUP BY 1)
SELECT a.anchor AS source1_entity_id, coalesce(matched_entity_ids, '') AS matched_entity_ids FROM anchors a LEFT JOIN sized USING (anchor)""")
def link_parties(spark: SparkSession, d: str) -> DataFrame:
    """Normalize, block, score, link, assemble: one row a reference."""
    return sinks.wide(split(spark, d)[0].select("entity_id"), scored(spark, d).where("score >= 0.5"), "matched_entity_ids")


@query(f"WITH {sql.RECORDS} SELECT entity_id, name, address, country, core, source FROM rec")
def norm_record(spark: SparkSession, d: str) -> DataFrame:
    return normalize.records(tables.parties(spark, d))


@query(f"WITH {sql.RECORDS} SELECT entity_id, name, address, country, core, source FROM rec")
def normalized_cache(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d)


@query(f"SELECT doc_id, {sql.text('text')} AS clean FROM documents")
def norm_text(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet").select("doc_id", normalize.clean(F.col("text")).alias("clean"))


@query(f"SELECT page_id, {sql.text('url')} AS clean, regexp_replace(lower(url), '{sql.WEB_ADDRESS}', ' \\1 ', 'g') AS stem FROM pages")
def norm_url_stem(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/pages.parquet").select("page_id", normalize.clean(F.col("url")).alias("clean"), normalize.web_stem(F.lower("url")).alias("stem"))


@query(f"WITH {sql.RECORDS} SELECT entity_id, array_to_string({sql.numbers('address')}, ' ') AS numbers, replace(core, ' ', '') AS compact FROM rec")
def numbers_extract(spark: SparkSession, d: str) -> DataFrame:
    return records(spark, d).select("entity_id", F.array_join(normalize.numbers(F.col("address")), " ").alias("numbers"), normalize.compact(F.col("core")).alias("compact"))


def _keys_query(name: str, tags: str) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return blocking.keys(records(spark, d), list(tags), ("entity_id",))

    run.__name__ = name
    query(f"WITH {sql.KEYS} SELECT entity_id, tag, key FROM keys WHERE tag IN ({', '.join(map(repr, tags))})")(run)


for _name, _tags in (("keys_name", NAME_KEYS), ("keys_token", TOKEN_KEYS), ("keys_pair", PAIR_KEYS), ("keys_address", ADDRESS_KEYS), ("keys_number", NUMBER_KEYS)):
    _keys_query(_name, _tags)


@query(f"WITH {sql.KEYS} SELECT country, tag, key, df FROM df")
def key_df(spark: SparkSession, d: str) -> DataFrame:
    return blocking.key_frequencies(blocking.keys(split(spark, d)[0]))


@query(f"WITH {sql.KEYS} SELECT country, tag, key, df FROM usable")
def key_df_capped(spark: SparkSession, d: str) -> DataFrame:
    return blocking.usable_keys(blocking.keys(split(spark, d)[0]))


@query(f"WITH {sql.KEYS} SELECT anchor, candidate FROM cand")
def blocking_candidates(spark: SparkSession, d: str) -> DataFrame:
    return blocking.candidates(*split(spark, d))


@query(f"""WITH {sql.KEYS}, own AS (SELECT keys.* FROM keys WHERE source = 1 AND {sql.crc32('entity_id')} % 1000000 < 300000)
SELECT DISTINCT a.entity_id AS anchor, b.entity_id AS candidate FROM own a JOIN usable USING (country, tag, key) JOIN keys b USING (country, tag, key) WHERE b.source <> 1""")
def blocking_of_sample(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of sampled references, keys counted over all of them."""
    one, rest = split(spark, d)
    return blocking.candidates(sampling.sampled(one, 0.3), rest, one)


@query(f"WITH {sql.KEYS} SELECT entity_id AS anchor, count(candidate) AS n FROM rec LEFT JOIN cand ON entity_id = anchor WHERE source = 1 GROUP BY 1")
def candidates_per_ref(spark: SparkSession, d: str) -> DataFrame:
    one, rest = split(spark, d)
    each = blocking.candidates(one, rest).groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    return one.select(F.col("entity_id").alias("anchor")).join(each, "anchor", "left").fillna(0, ["n"])


@query(f"WITH {sql.KEYS} SELECT tag, count(DISTINCT anchor || ' ' || candidate) AS pairs, count(DISTINCT key) AS keys FROM routes GROUP BY 1")
def route_contribution(spark: SparkSession, d: str) -> DataFrame:
    return blocking.routes(*split(spark, d)).groupBy("tag").agg(F.countDistinct("anchor", "candidate").alias("pairs"), F.countDistinct("key").alias("keys"))


def _set_sql() -> str:
    out = []
    for f, c in (("name", "n"), ("core", "c"), ("address", "a")):
        a, b = sql.words(f"x{c}"), sql.words(f"y{c}")
        both = f"x{c} <> '' AND y{c} <> ''"
        out += [
            f"round({sql.jaccard(a, b)}, 6) AS {f}_jaccard",
            f"round({sql.contained(a, b)}, 6) AS {f}_contain",
            f"round(least(length(x{c}), length(y{c})) / greatest(1, length(x{c}), length(y{c})), 6) AS {f}_length_ratio",
            f"CASE WHEN {both} AND x{c} = y{c} THEN 1.0::DOUBLE ELSE 0.0 END AS {f}_exact",
            f"CASE WHEN {both} THEN 0.0::DOUBLE ELSE 1.0 END AS {f}_missing",
        ]
    return ", ".join(out)


@query(f"WITH {sql.PAIRS} SELECT anchor, candidate, {_set_sql()} FROM pairs")
def set_feature_pairs(spark: SparkSession, d: str) -> DataFrame:
    made: dict = {}
    for f in ("name", "core", "address"):
        made |= features._set_columns(f)
    return rounded(pairs(spark, d).select("anchor", "candidate", *[c.alias(n) for n, c in made.items()]))


@query(f"WITH {sql.PAIRS} SELECT anchor, candidate, CAST(levenshtein(replace(xc, ' ', ''), replace(yc, ' ', '')) AS BIGINT) AS distance FROM pairs")
def levenshtein_pairs(spark: SparkSession, d: str) -> DataFrame:
    k = lambda s: normalize.compact(F.col(f"{s}.core"))
    return pairs(spark, d).select("anchor", "candidate", F.levenshtein(k("x"), k("y")).cast("long").alias("distance"))


@query(f"WITH {sql.PAIRS} SELECT anchor, candidate, round(jaro_winkler_similarity(xn, yn), 6) AS similarity FROM pairs")
def jw_pairs(spark: SparkSession, d: str) -> DataFrame:
    return rounded(pairs(spark, d).select("anchor", "candidate", similarity.scorer(similarity.jaro_winkler)("x.name", "y.name").alias("similarity")))


def _kernel_query(name: str, kernel, column: str | None = None, field: str = "core") -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return by_record(class_pairs(spark, d), [similarity.scorer(kernel)(f"x.{field}", f"y.{field}").alias("similarity")])

    run.__name__ = name
    x, y = f"x{field[0]}", f"y{field[0]}"
    query(column and f"WITH {sql.PAIRS}, {sql.kernels(x, y)} SELECT anchor, candidate, round({column}, 6) AS similarity FROM pairs JOIN kernels ON a = {x} AND b = {y}")(run)


for _name, _kernel, _column in (("indel_ratio_pairs", similarity.ratio, "ratio"), ("token_sort_pairs", similarity.token_sort, "token_sort"), ("token_set_pairs", similarity.token_set, "token_set"), ("partial_ratio_pairs", similarity.partial, None)):
    _kernel_query(_name, _kernel, _column)


@query(sql.for_documents(f"""WITH {sql.PAIRS}, {sql.kernels('xa', 'ya')} SELECT anchor, candidate, round(ratio, 6) AS ratio, round(token_sort, 6) AS token_sort, round(token_set, 6) AS token_set
FROM pairs JOIN kernels ON a = xa AND b = ya"""))
def kernels_documents(spark: SparkSession, d: str) -> DataFrame:
    """The kernels on what documents say: natural words, of which many pairs share some."""
    kernels = {"ratio": similarity.ratio, "token_sort": similarity.token_sort, "token_set": similarity.token_set}
    return rounded(features.spread(document_pairs(spark, d)).select("anchor", "candidate", *[similarity.scorer(k)("x.address", "y.address").alias(n) for n, k in kernels.items()]))


@query(f"""WITH {sql.PAIRS}, e AS (SELECT DISTINCT xc, yc, unnest({sql.words('xc')}) AS u FROM pairs), texts AS (SELECT DISTINCT u AS a, unnest({sql.words('yc')}) AS b FROM e),{sql.KERNELS},
t AS (SELECT xc, unnest({sql.words('xc')}) AS u, range(len({sql.words('xc')})) AS i, yc FROM (SELECT DISTINCT xc, yc FROM pairs)),
w AS (SELECT xc, yc, u, max(ratio) / 100 AS best FROM (SELECT DISTINCT xc, yc, u, unnest({sql.words('yc')}) AS v FROM e) JOIN kernels ON a = u AND b = v GROUP BY ALL),
s AS (SELECT xc, yc, min(coalesce(best, 0)) AS worst, avg(coalesce(best, 0)) AS mean FROM t LEFT JOIN w USING (xc, yc, u) GROUP BY ALL)
SELECT anchor, candidate, round(coalesce(worst, 0), 6) AS worst_token, round(coalesce(mean, 0), 6) AS mean_token FROM pairs LEFT JOIN s USING (xc, yc)""")
def best_token_pairs(spark: SparkSession, d: str) -> DataFrame:
    made = class_pairs(spark, d).withColumn("f", similarity.full_scores(["worst_token", "mean_token"]))
    return by_record(made, [F.col("f.worst_token"), F.col("f.mean_token")])


def _only(x: str, y: str) -> str:
    return f"list_filter(list_distinct({sql.numbers(x)}), lambda n: NOT list_contains({sql.numbers(y)}, n))"


@query(f"""WITH {sql.PAIRS}, l AS (SELECT DISTINCT xa, ya, unnest({_only('xa', 'ya')}) AS u FROM pairs), n AS (SELECT xa, ya, u AS a, unnest({_only('ya', 'xa')}) AS b FROM l),
texts AS (SELECT DISTINCT a, b FROM n),{sql.KERNELS}, s AS (SELECT xa, ya, max(ratio) / 100 AS best FROM n JOIN kernels USING (a, b) GROUP BY ALL)
SELECT anchor, candidate, round(coalesce(best, 0), 6) AS similarity FROM pairs LEFT JOIN s USING (xa, ya)""")
def number_similarity_pairs(spark: SparkSession, d: str) -> DataFrame:
    na, nb = (normalize.numbers(F.col(f"{side}.address")) for side in ("x", "y"))
    made = features.spread(pairs(spark, d)).select("anchor", "candidate", similarity.best_number_ratio(F.array_except(na, nb), F.array_except(nb, na)).alias("similarity"))
    return rounded(made)


@query(f"""WITH {sql.PAIRS} SELECT anchor, candidate, CAST(levenshtein(replace(xc, ' ', ''), replace(yc, ' ', '')) AS BIGINT) AS edits,
CAST(length(replace(yc, ' ', '')) - length(replace(xc, ' ', '')) AS BIGINT) AS growth FROM pairs""")
def edit_ops_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The sum of the edit kinds, and insertions less deletions: what all shortest scripts have in common."""
    made = class_pairs(spark, d).withColumn("f", similarity.full_scores(["replaced", "inserted", "deleted"]))
    return by_record(made, [(F.col("f.replaced") + F.col("f.inserted") + F.col("f.deleted")).cast("long").alias("edits"), (F.col("f.inserted") - F.col("f.deleted")).cast("long").alias("growth")])


@query(f"WITH {sql.GATED} SELECT anchor, candidate FROM gated")
def gate_pairs(spark: SparkSession, d: str) -> DataFrame:
    return features.scored_for_gate(pairs(spark, d)).where(features.gate()).select("anchor", "candidate")


@query(sql.for_documents(f"WITH {sql.GATED} SELECT anchor, candidate FROM gated"))
def gate_documents(spark: SparkSession, d: str) -> DataFrame:
    """Of pairs that blocking finds among documents the gate rejects a good share."""
    return features.scored_for_gate(document_pairs(spark, d)).where(features.gate()).select("anchor", "candidate")


def _number_sql() -> str:
    na, nb, ma, mb = (sql.numbers(x) for x in ("xa", "ya", "xn", "yn"))
    some, da, db = f"len({na}) > 0 AND len({nb}) > 0", f"list_filter(list_distinct({na}), lambda n: NOT list_contains({nb}, n))", f"list_filter(list_distinct({nb}), lambda n: NOT list_contains({na}, n))"
    both = f"len(list_intersect(list_distinct({na}), list_distinct({nb})))"
    short = lambda x: f"list_transform(list_filter({x}, lambda n: length(n) < 12), lambda n: CAST(n AS BIGINT))"
    near = f"list_min(flatten(list_transform({short(da)}, lambda u: list_transform({short(db)}, lambda v: abs(u - v)))))"
    flag = lambda x: f"CASE WHEN {x} THEN 1.0::DOUBLE ELSE 0.0 END"
    return f"""round({sql.jaccard(na, nb)}, 6) AS number_jaccard, {flag(f'{some} AND {both} = 0')} AS number_conflict, {both}::DOUBLE AS number_common, {flag(f'NOT ({some})')} AS number_missing,
{flag(f'{some} AND ({na})[1] = ({nb})[1]')} AS first_number_equal, {flag(f'len({ma}) > 0 AND len({mb}) > 0 AND list_sort(list_distinct({ma})) <> list_sort(list_distinct({mb}))')} AS name_number_conflict,
len({da})::DOUBLE AS unmatched_left_numbers, len({db})::DOUBLE AS unmatched_right_numbers, round(ln(1 + least(coalesce({near}, 0), 1000000)), 6) AS number_delta_log, {flag(f'{near} <= 2')} AS number_near_miss"""


@query(f"WITH {sql.PAIRS} SELECT anchor, candidate, {_number_sql()} FROM pairs")
def number_features(spark: SparkSession, d: str) -> DataFrame:
    made = features.number_columns() | features.unmatched_number_columns()
    return rounded(pairs(spark, d).select("anchor", "candidate", *[c.alias(n) for n, c in made.items()]))


@query(f"""WITH {sql.RECORDS} SELECT entity_id,
{', '.join(f"CASE WHEN {f} = '' THEN 0.0 ELSE round(ln(1 + least(1000, count(*) OVER (PARTITION BY country, {f}))), 6) END AS reference_{f}_frequency" for f in ('name', 'core', 'address'))}
FROM rec WHERE source = 1""")
def reference_frequency(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.with_reference_frequencies(split(spark, d)[0]).select("entity_id", *REFERENCE_COLUMNS))


@query(f"""WITH {sql.RECORDS} SELECT entity_id, round(ln(1 + least(1000, count(*) OVER (PARTITION BY country, core))), 6) AS source_core_frequency,
round(ln(1 + least(1000, count(*) OVER (PARTITION BY country, core, address))), 6) AS source_core_address_frequency FROM rec WHERE source <> 1""")
def source_frequency(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.with_source_frequencies(split(spark, d)[1]).select("entity_id", *SOURCE_COLUMNS))


@query(f"""WITH {sql.RECORDS} SELECT country, core, NULL AS address, count(*) AS n FROM rec WHERE source <> 1 GROUP BY ALL
UNION ALL SELECT country, core, address, count(*) FROM rec WHERE source <> 1 GROUP BY ALL""")
def source_profile(spark: SparkSession, d: str) -> DataFrame:
    """Both profiles; address is null in that by core alone."""
    by_core, by_both = features.source_profile(split(spark, d)[1])
    return by_core.select("country", "core", F.lit(None).cast("string").alias("address"), "n").unionByName(by_both)


@query(f"WITH {sql.RECORDS} SELECT country, count(*) AS n FROM rec WHERE source = 1 GROUP BY 1")
def country_counts(spark: SparkSession, d: str) -> DataFrame:
    return split(spark, d)[0].groupBy("country").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {sql.RECORDS} SELECT entity_id FROM rec WHERE source = 1 AND {sql.crc32('entity_id')} % 1000000 < 300000")
def crc_sample(spark: SparkSession, d: str) -> DataFrame:
    return sampling.sampled(split(spark, d)[0], 0.3).select("entity_id")


_GROUP = sql.crc32("(country || '|' || name || '|' || address)") + " % 10"


@query(f"WITH {sql.RECORDS}, g AS (SELECT entity_id, CAST({_GROUP} AS INTEGER) AS grp FROM rec WHERE source = 1) SELECT entity_id, grp, CASE WHEN grp < 6 THEN 'fit' WHEN grp < 8 THEN 'tune' ELSE 'audit' END AS part FROM g")
def split_groups(spark: SparkSession, d: str) -> DataFrame:
    return split(spark, d)[0].select("entity_id", sampling.group_of().alias("grp")).withColumn("part", sampling.part_of(F.col("grp")))


@query(f"WITH {sql.SCORED} SELECT anchor, candidate, label FROM scored")
def truth_labels(spark: SparkSession, d: str) -> DataFrame:
    return sampling.labelled(pairs(spark, d).select("anchor", "candidate"), truth(spark, d))


@query(f"""WITH {sql.SCORED}, g AS (SELECT entity_id AS anchor FROM rec WHERE source = 1 AND {_GROUP} < 6),
all_ AS (SELECT anchor, candidate, 1 AS retrieved FROM cand UNION ALL SELECT anchor, candidate, 0 FROM truth JOIN g USING (anchor))
SELECT anchor, candidate, max(retrieved) AS retrieved FROM all_ GROUP BY ALL""")
def inject_positives(spark: SparkSession, d: str) -> DataFrame:
    one, rest = split(spark, d)
    fit = one.where(sampling.group_of() < 6).select(F.col("entity_id").alias("anchor"))
    return sampling.injected(blocking.candidates(one, rest), truth(spark, d).join(fit, "anchor", "left_semi"))


@query(f"WITH {sql.SCORED}, s AS ({sql.scores(0.5)}) SELECT count(*) AS entities, round(avg(f), 6) AS macro_f05 FROM s")
def macro_f05(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.macro(evaluate.entity_scores(anchors(spark, d), scored(spark, d), 0.5)))


@query(f"""WITH {sql.SCORED}, s AS ({sql.scores(0.5)}) SELECT country, count(*) AS entities, round(avg(f), 6) AS macro_f05,
round(sum(hits) / greatest(1, sum(predicted)), 6) AS precision, round(sum(hits) / greatest(1, sum("true")), 6) AS recall FROM s GROUP BY ROLLUP (country)""")
def micro_pr_by_country(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.country_report(evaluate.entity_scores(anchors(spark, d), scored(spark, d), 0.5)))


@query(f"WITH {sql.SWEEP} SELECT threshold, round(avg(f), 6) AS macro_f05 FROM swept GROUP BY 1")
def threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.sweep(anchors(spark, d), scored(spark, d)).select("threshold", F.round("macro_f05", 6).alias("macro_f05"))


@query(f"""WITH {sql.SWEEP}, m AS (SELECT country, threshold, round(avg(f), 12) AS f FROM swept GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY f DESC, threshold) AS n FROM m) SELECT country, threshold, round(f, 6) AS macro_f05 FROM r WHERE n = 1""")
def country_thresholds(spark: SparkSession, d: str) -> DataFrame:
    best = evaluate.best_threshold(evaluate.sweep(anchors(spark, d), scored(spark, d), by=("country",)), ("country",))
    return best.select("country", "threshold", F.round("macro_f05", 6).alias("macro_f05"))


@query(f"""WITH {sql.SCORED}, cuts(cutoff) AS (VALUES {sql.CUTOFFS}),
c AS (SELECT anchor, cutoff, count(*) AS p, sum(label) AS h FROM scored JOIN cuts ON screen >= cutoff WHERE score >= 0.5 GROUP BY ALL)
SELECT cutoff, round(avg({sql.f05('coalesce(p, 0)', 'coalesce(h, 0)', '"true"')}), 6) AS macro_f05 FROM anchors CROSS JOIN cuts LEFT JOIN c USING (anchor, cutoff) GROUP BY 1""")
def screen_cutoffs(spark: SparkSession, d: str) -> DataFrame:
    made = evaluate.cutoff_scores(anchors(spark, d), scored(spark, d), 0.0003, 0.5)
    return made.select("cutoff", F.round("macro_f05", 6).alias("macro_f05"))


@query(f"""WITH {sql.SCORED}, cuts(cutoff) AS (VALUES {sql.CUTOFFS}),
c AS (SELECT anchor, cutoff, count(*) AS p, sum(label) AS h FROM scored JOIN cuts ON screen >= cutoff WHERE score >= 0.5 GROUP BY ALL),
v AS (SELECT cutoff, avg({sql.f05('coalesce(p, 0)', 'coalesce(h, 0)', '"true"')}) AS f FROM anchors CROSS JOIN cuts LEFT JOIN c USING (anchor, cutoff) GROUP BY 1)
SELECT max(cutoff) AS cutoff FROM v WHERE f >= (SELECT max(f) FROM v) - 0.0002""")
def screen_cutoff(spark: SparkSession, d: str) -> DataFrame:
    return evaluate.chosen_cutoff(evaluate.cutoff_scores(anchors(spark, d), scored(spark, d), 0.0003, 0.5))


@query(f"WITH {sql.SCORED} SELECT round(quantile_cont(screen, 0.0005), 6) AS q FROM scored WHERE label = 1")
def screen_quantile(spark: SparkSession, d: str) -> DataFrame:
    return scored(spark, d).where("label = 1").agg(F.round(F.percentile("screen", F.lit(0.0005)), 6).alias("q"))


@query(f"""WITH {sql.SCORED} SELECT CAST((SELECT sum(label) FROM scored) AS BIGINT) AS found, count(*) AS "true", round((SELECT sum(label) FROM scored) / count(*), 6) AS recall FROM anchors""")
def blocking_recall(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.recall(scored(spark, d), anchors(spark, d)))


@query(f"""WITH {sql.SCORED}, s AS ({sql.scores(0.5)}), e AS (SELECT avg(f) AS m, stddev_samp(f) / sqrt(count(*)) AS e FROM s)
SELECT round(m, 6) AS mean, round(greatest(0, m - 1.96 * e), 6) AS low, round(least(1, m + 1.96 * e), 6) AS high FROM e""")
def audit_ci(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.confidence(evaluate.entity_scores(anchors(spark, d), scored(spark, d), 0.5)))


@query(f"WITH {sql.SCORED}, s AS ({sql.scores(0, 'label = 1')}) SELECT count(*) AS entities, round(avg(f), 6) AS macro_f05 FROM s")
def oracle_ceiling(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.macro(evaluate.entity_scores(anchors(spark, d), evaluate.ceiling(scored(spark, d)), 0.5)))


@query(f"WITH {sql.SCORED} SELECT round(avg(CASE WHEN screen >= 0.3 THEN 1.0 ELSE 0.0 END), 6) AS kept, round(avg(CASE WHEN screen >= 0.3 THEN 1.0 ELSE 0.0 END) FILTER (label = 1), 6) AS kept_matches FROM scored")
def screen_retention(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.retention(scored(spark, d), 0.3))


@query(f"""WITH {sql.SCORED}, said AS (SELECT anchor, candidate FROM scored WHERE score >= 0.5)
SELECT anchor, candidate, 'retrieval_miss' AS kind FROM truth ANTI JOIN cand USING (anchor, candidate)
UNION ALL SELECT anchor, candidate, 'false_negative' FROM truth ANTI JOIN said USING (anchor, candidate)
UNION ALL SELECT anchor, candidate, 'false_positive' FROM said ANTI JOIN truth USING (anchor, candidate)""")
def error_diff(spark: SparkSession, d: str) -> DataFrame:
    return diagnose.differences(truth(spark, d), scored(spark, d), 0.5)


_WRONG = """said AS (SELECT anchor, candidate FROM scored WHERE score >= 0.5),
wrong AS (SELECT anchor, candidate, 'retrieval_miss' AS kind FROM truth ANTI JOIN cand USING (anchor, candidate)
  UNION ALL SELECT anchor, candidate, 'false_negative' FROM truth ANTI JOIN said USING (anchor, candidate)
  UNION ALL SELECT anchor, candidate, 'false_positive' FROM said ANTI JOIN truth USING (anchor, candidate))"""
_KINDS = ("retrieval_miss", "false_negative", "false_positive")


@query(f"""WITH {sql.SCORED}, {_WRONG}
SELECT anchor, {', '.join(f"coalesce(string_agg(DISTINCT candidate, ',' ORDER BY candidate) FILTER (kind = '{k}'), '') AS {k}" for k in _KINDS)}, name, address, country
FROM wrong JOIN rec ON entity_id = anchor GROUP BY anchor, name, address, country ORDER BY anchor LIMIT 100""")
def error_examples(spark: SparkSession, d: str) -> DataFrame:
    one, _ = split(spark, d)
    made = diagnose.examples(diagnose.differences(truth(spark, d), scored(spark, d), 0.5), one)
    return made.select("anchor", *[F.array_join(F.coalesce(k, F.array().cast("array<string>")), ",").alias(k) for k in _KINDS], "name", "address", "country")


@query(f"""WITH {sql.SCORED}, s AS ({sql.scores(0.5)}), said AS (SELECT anchor, string_agg(candidate, ',' ORDER BY candidate) AS predicted FROM scored WHERE score >= 0.5 GROUP BY 1),
t AS (SELECT anchor, string_agg(candidate, ',' ORDER BY candidate) AS truth FROM truth GROUP BY 1)
SELECT s.anchor, s.country, name, address, round(f, 6) AS score, coalesce(truth, '') AS truth, coalesce(said.predicted, '') AS predicted
FROM s JOIN rec ON entity_id = s.anchor LEFT JOIN t ON t.anchor = s.anchor LEFT JOIN said ON said.anchor = s.anchor WHERE f < 0.999""")
def audit_errors(spark: SparkSession, d: str) -> DataFrame:
    one, _ = split(spark, d)
    made = scored(spark, d)
    return rounded(diagnose.audit_errors(evaluate.entity_scores(anchors(spark, d), made, 0.5), truth(spark, d), made.where("score >= 0.5"), one))


@query(sql.for_documents(f"""WITH {sql.GATED}, m AS (SELECT anchor, candidate FROM cand UNION SELECT anchor, candidate || '0' FROM cand)
SELECT count(*) AS total, count(*) FILTER (EXISTS (FROM gated g WHERE g.anchor = m.anchor AND g.candidate = m.candidate)) AS recovered,
count(*) FILTER (EXISTS (FROM cand c WHERE c.anchor = m.anchor AND c.candidate = m.candidate) AND NOT EXISTS (FROM gated g WHERE g.anchor = m.anchor AND g.candidate = m.candidate)) AS gate_rejected FROM m"""))
def assess_documents(spark: SparkSession, d: str) -> DataFrame:
    """Pairs found and pairs of unknown records, after blocking and gate ran anew: what the gate rejects is told apart."""
    found = document_pairs(spark, d)
    gated = features.scored_for_gate(found).where(features.gate())
    misses = found.select("anchor", "candidate").unionByName(found.select("anchor", F.concat("candidate", F.lit("0")).alias("candidate")))
    return diagnose.assessed(misses, found, gated)


@query(f"""WITH {sql.SCORED}, m AS (SELECT DISTINCT anchor, candidate FROM truth)
SELECT count(*) AS total, count(*) FILTER (EXISTS (FROM cand c WHERE c.anchor = m.anchor AND c.candidate = m.candidate)) AS retrieved FROM m""")
def assess_truth(spark: SparkSession, d: str) -> DataFrame:
    """Of all true pairs, how many blocking alone finds again."""
    one, rest = split(spark, d)
    found = blocking.candidates(one, rest)
    return diagnose.assessed(truth(spark, d), found, found).selectExpr("total", "recovered AS retrieved")


def _broken(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Output tables that break every rule somewhere: by reference key modulo 7 and 11."""
    key = F.col("c_custkey")
    c = spark.read.parquet(f"{d}/customer.parquet").select(key, F.concat(F.lit("S1-"), key).alias("anchor"), F.concat(F.lit("S2-"), key).alias("id"))
    bad = F.when(key % 7 == 1, F.concat("id", F.lit(","), "id")).when(key % 7 == 2, F.col("anchor")).when(key % 7 == 3, F.concat(F.lit("X-"), key)).when(key % 7 == 4, F.concat("id", F.lit("9999999"))).when(key % 7 == 5, "").otherwise(F.col("id"))
    rows = c.select(key.alias("line"), "anchor", bad.alias("ids"))
    rows = rows.where("line % 11 != 3").unionByName(rows.where("line % 11 = 4")).unionByName(rows.where("line % 11 = 5").withColumn("anchor", F.concat("anchor", F.lit("-unknown"))))
    # Rows of one line stand in the order of their anchors.
    refs = c.select(key.alias("line"), F.col("anchor").alias("entity_id"))
    return rows, c.select(key.alias("line"), "anchor", F.col("id").alias("ids")), refs, c.select(F.col("id").alias("entity_id"))


_BROKEN = """c AS (SELECT c_custkey AS k, 'S1-' || c_custkey AS a, 'S2-' || c_custkey AS i FROM customer),
b AS (SELECT k, a, CASE k % 7 WHEN 1 THEN i || ',' || i WHEN 2 THEN a WHEN 3 THEN 'X-' || k WHEN 4 THEN i || '9999999' WHEN 5 THEN '' ELSE i END AS ids FROM c),
r AS (SELECT * FROM b WHERE k % 11 <> 3 UNION ALL SELECT * FROM b WHERE k % 11 = 4 UNION ALL SELECT k, a || '-unknown', ids FROM b WHERE k % 11 = 5),
l AS (SELECT a, list_filter(string_split(ids, ','), lambda x: x <> '') AS ids FROM r), e AS (SELECT DISTINCT a, unnest(ids) AS i FROM l),
found AS (SELECT 'duplicate_row' AS rule, a AS offender FROM r GROUP BY a HAVING count(*) > 1
UNION ALL SELECT 'duplicate_id', a FROM l WHERE len(ids) <> len(list_distinct(ids))
UNION ALL SELECT 'self_match', a || ' ' || i FROM e WHERE i LIKE 'S1-%'
UNION ALL SELECT 'wrong_prefix', a || ' ' || i FROM e WHERE i NOT LIKE 'S1-%' AND i NOT LIKE 'S2-%' AND i NOT LIKE 'S3-%'
UNION ALL SELECT 'missing_row', a FROM c ANTI JOIN r USING (a)
UNION ALL SELECT DISTINCT 'unknown_row', a FROM r ANTI JOIN c USING (a)
UNION ALL SELECT 'unknown_target', a || ' ' || i FROM e ANTI JOIN c USING (i) WHERE i LIKE 'S2-%' OR i LIKE 'S3-%'
UNION ALL SELECT 'not_a_candidate', a || ' ' || i FROM e ANTI JOIN c USING (a, i))"""


@query(f"WITH {_BROKEN} SELECT rule, offender FROM found")
def validate_rules(spark: SparkSession, d: str) -> DataFrame:
    rows, whole, refs, targets = _broken(spark, d)
    return validate.check_lists(rows, refs, targets).unionByName(validate.check_subset(rows, whole)).select("rule", "offender")


@query(f"""WITH {_BROKEN}, got AS (SELECT a, row_number() OVER (ORDER BY k, a) AS n FROM r), want AS (SELECT a, row_number() OVER (ORDER BY k) AS n FROM c),
disorder AS (SELECT coalesce(want.a, got.a) AS offender FROM want FULL JOIN got USING (n) WHERE want.a IS DISTINCT FROM got.a),
all_ AS (SELECT * FROM found UNION ALL SELECT 'order', offender FROM disorder)
SELECT 'matches' AS "table", rule, 'error' AS severity, count(*) AS n, array_to_string(list_sort(list(DISTINCT offender))[1:5], ', ') AS examples FROM all_ GROUP BY rule""")
def validate_strict(spark: SparkSession, d: str) -> DataFrame:
    return validate.summary(validate.validate(*_broken(spark, d), strict=True))


_FREQUENCIES = ", ".join(f"CASE WHEN {f} = '' THEN 0.0 ELSE ln(1 + least(1000, count(*) OVER (PARTITION BY country, {f}))) END AS reference_{f}_frequency" for f in ("name", "core", "address"))
_VECTOR = f"""{sql.GATED}, rf AS (SELECT entity_id AS anchor, {_FREQUENCIES} FROM rec WHERE source = 1),
sf AS (SELECT entity_id AS candidate, ln(1 + least(1000, count(*) OVER (PARTITION BY country, core))) AS source_core_frequency, ln(1 + least(1000, count(*) OVER (PARTITION BY country, core, address))) AS source_core_address_frequency FROM rec WHERE source <> 1),
vec AS (SELECT * FROM gated JOIN rf USING (anchor) JOIN sf USING (candidate))"""
_SHORT = {"name": "n", "core": "c", "address": "a"}


def _screen_sql(column: str) -> str:
    field = column.split("_")[0]
    both = f"x{_SHORT.get(field, '')} <> '' AND y{_SHORT.get(field, '')} <> ''"
    if field in ("reference", "source"):
        return f"round({column}, 6) AS {column}"
    return f"CASE WHEN {both} THEN {'0.0::DOUBLE' if column.endswith('missing') else f'round({column} / 100, 6)'} ELSE {'1.0' if column.endswith('missing') else '0.0'} END AS {column}"


@query(f"WITH {_VECTOR} SELECT anchor, candidate, {', '.join(map(_screen_sql, SCREEN_COLUMNS))} FROM vec")
def screen_features(spark: SparkSession, d: str) -> DataFrame:
    return by_record(gated_classes(spark, d), [c.alias(n) for n, c in features.screen_columns().items()])


def gated_classes(spark: SparkSession, d: str) -> DataFrame:
    return linkage.gated_pairs(linkage.alike_of_raw(tables.parties(spark, d)))


def vector(spark: SparkSession, d: str, columns: list[str]) -> DataFrame:
    return by_record(features.model_columns(gated_classes(spark, d), columns), [F.col(c) for c in columns])


def _scored(x: str, y: str, value: str, column: str) -> str:
    return f"round(CASE WHEN {x} <> '' AND {y} <> '' THEN {value} ELSE 0.0 END, 6) AS {column}"


#: Columns of the model that SQL can say and that no other query shows beside the rest.
_MORE = [
    _scored("xn", "yn", "n2.token_sort / 100", "name_sort"),
    _scored("xn", "yn", "n2.token_set / 100", "name_set"),
    *[_scored(f"x{c}", f"y{c}", f"jaro_winkler_similarity(x{c}, y{c})", f"{f}_jw") for f, c in _SHORT.items()],
    _scored("xc", "yc", "k2.ratio / 100", "compact_name_ratio"),
    "round(CASE WHEN xc <> '' AND yc <> '' THEN core_ratio / 100 ELSE 0.0 END * CASE WHEN xa <> '' AND ya <> '' THEN address_ratio / 100 ELSE 0.0 END, 6) AS name_addr_product",
    "least(length(xn), length(yn))::DOUBLE AS name_length",
    "least(length(xa), length(ya))::DOUBLE AS address_length",
    "CASE WHEN candidate LIKE 'S3%' THEN 1.0::DOUBLE ELSE 0.0 END AS source3",
]
_NOT_IN_SQL = [c for c in MODEL_COLUMNS if c.endswith(("_partial", "_rate")) or c in ("unmatched_number_similarity", "worst_name_token_similarity", "mean_name_token_similarity")]


@query(f"""WITH {_VECTOR.replace("UNION SELECT xa, ya FROM pairs)", "UNION SELECT xa, ya FROM pairs UNION SELECT replace(xc, ' ', ''), replace(yc, ' ', '') FROM pairs)")}
SELECT anchor, candidate, {', '.join(_screen_sql(c) for c in SCREEN_COLUMNS if not c.endswith('missing'))}, {_set_sql()}, {_number_sql()}, {', '.join(_MORE)}
FROM vec JOIN kernels n2 ON n2.a = xn AND n2.b = yn JOIN kernels k2 ON k2.a = replace(xc, ' ', '') AND k2.b = replace(yc, ' ', '')""")
def feature_columns(spark: SparkSession, d: str) -> DataFrame:
    """The columns of the feature vector that SQL can express; the others have queries or brute-force tests of their own."""
    return vector(spark, d, [c for c in MODEL_COLUMNS if c not in _NOT_IN_SQL])


@query()
def feature_vector(spark: SparkSession, d: str) -> DataFrame:
    return vector(spark, d, MODEL_COLUMNS)


@query()
def cascade_predict(spark: SparkSession, d: str) -> DataFrame:
    """Trains both tiers on the parties and links them; scores near their decision may differ by cluster, links hardly."""
    from . import cascade

    found = linkage.alike_of_raw(tables.parties(spark, d))
    prepared, who = linkage.prepared_classes(found, tables.party_truth(spark, d))
    prepared = prepared.persist()
    bundle, _ = cascade.train(prepared, who)
    prepared.unpersist()
    return rounded(linkage.linked_classes(found, bundle), 4)
