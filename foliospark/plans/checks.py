"""Queries that check ingested and augmented data. Small rasters: the 64 numbers of a vector as 8 x 8 gray pixels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.text import strip
from ..functions.vectors import dot
from ..session import read_table, stage
from .registry import CORE

MIN_ROWS, MAX_BLANK, MIN_INSIDE = 100, 0.05, 0.95
REQUIRED = ("image_id", "image_png", "transcription", "split")
_SPLIT = "case when lower(trim(split)) = 'val' then 'validation' else lower(trim(split)) end"
_WS = r"[\s\x0b\x1c-\x1f\x85\pZ]"


def _split():
    s = F.lower(F.trim("split"))
    return F.when(s == "val", "validation").otherwise(s)


@CORE.add("split_counts", f"select {_SPLIT} as split, count(*) as n, count(*) >= 100 as passed from line_images group by 1")
def split_counts(spark, sf_dir):
    """A01 Q-I1: rows of each split and whether they suffice."""
    return read_table(spark, sf_dir, "line_images").groupBy(_split().alias("split")).agg(F.count("*").alias("n"), (F.count("*") >= MIN_ROWS).alias("passed"))


@CORE.add("blank_transcriptions", f"select {_SPLIT} as split, count(*) filter (where regexp_replace(coalesce(transcription, ''), '{_WS}+', '', 'g') = '') as n_blank, round(count(*) filter (where regexp_replace(coalesce(transcription, ''), '{_WS}+', '', 'g') = '') / cast(count(*) as double), 6) as share from line_images group by 1")
def blank_transcriptions(spark, sf_dir):
    """A04 Q-I4: blank transcriptions of each split."""
    blank = (strip(F.coalesce("transcription", F.lit(""))) == "").cast("bigint")
    return read_table(spark, sf_dir, "line_images").groupBy(_split().alias("split")).agg(F.sum(blank).alias("n_blank"), F.round(F.sum(blank) / F.count("*"), 6).alias("share"))


_IHDR = "cast('0x' || substr(hex(image_png), 33, 8) as bigint) as width, cast('0x' || substr(hex(image_png), 41, 8) as bigint) as height"


def header_sizes(i):
    """Width and height from the header bytes, without decoding; null where there is no PNG header."""
    head = F.hex(F.substring("image_png", 1, 24))
    n = lambda at: F.when(head.startswith("89504E470D0A1A0A") & (F.length(head) == 48), F.conv(F.substring(head, at, 8), 16, 10).cast("bigint"))
    return i.select(_split().alias("split"), n(33).alias("width"), n(41).alias("height"))


@CORE.add(
    "image_bounds",
    f"with s as (select {_SPLIT} as split, {_IHDR} from line_images where substr(hex(image_png), 1, 16) = '89504E470D0A1A0A' and length(hex(image_png)) >= 48) select split, count(*) as n, count(*) filter (where height between 16 and 512 and width between 32 and 4096) as inside, min(width) as min_width, max(width) as max_width from s group by 1",
)
def image_bounds(spark, sf_dir):
    """Q-I5: pictures whose size lies within the bounds."""
    s = header_sizes(read_table(spark, sf_dir, "line_images")).where("width is not null")
    ok = (F.col("height").between(16, 512) & F.col("width").between(32, 4096)).cast("bigint")
    return s.groupBy("split").agg(F.count("*").alias("n"), F.sum(ok).alias("inside"), F.min("width").alias("min_width"), F.max("width").alias("max_width"))


_JUDGED = "case when n = 0 and check_name <> 'I0 any rows' then 'SKIP' when passed then 'PASS' else 'FAIL' end"


@CORE.add(
    "ingestion_checks",
    f"""with b as (select count(*) as n, count(*) filter (where regexp_replace(coalesce(transcription, ''), '{_WS}+', '', 'g') = '') as blank from line_images),
    m as (select min(n) as least from (select count(*) as n from line_images group by {_SPLIT})),
    i as (select count(*) as missing from (select unnest(['image_id', 'image_png', 'transcription', 'split']) as c) where not exists (select 1 from duckdb_columns() k where k.table_name = 'line_images' and k.column_name = c)),
    s as (select count(*) as n, count(*) filter (where height between 16 and 512 and width between 32 and 4096) as inside from (select {_IHDR} from line_images where substr(hex(image_png), 1, 16) = '89504E470D0A1A0A' and length(hex(image_png)) >= 48)),
    c as (select b.n, 'I0 any rows' as check_name, b.n > 0 as passed from b union all select b.n, 'I1 rows per split', coalesce(least, 0) >= 100 from m, b union all select b.n, 'I2 columns', missing = 0 from i, b
      union all select n, 'I4 blank transcriptions', n > 0 and blank / cast(n as double) <= 0.05 from b union all select b.n, 'I5 sizes', s.n > 0 and inside / cast(s.n as double) >= 0.95 from s, b)
    select check_name, {_JUDGED} as status, case when n = 0 then 0 when passed then 0 else 1 end as exit_code from c
    union all select 'all', case when max(n) = 0 then 'SKIP' when bool_and(passed) then 'PASS' else 'FAIL' end, case when max(n) = 0 or bool_and(passed) then 0 else 1 end from c""",
)
def ingestion_checks(spark, sf_dir):
    """Q-I0 Q-I1 Q-I2 Q-I4 Q-I5 A12 Q-EXIT: a row for each check and one for all, PASS, FAIL or, for an empty table, SKIP, with the exit code."""
    return checked(read_table(spark, sf_dir, "line_images"))


def checked(images):
    """``check_name, status, exit_code``; where a column is missing the later checks do not run."""
    missing = [c for c in REQUIRED if c not in images.columns]
    n = images.agg(F.count("*").alias("n"))
    row = lambda df, name, ok: df.select("n", F.lit(name).alias("check_name"), ok.alias("passed"))
    rows = row(n, "I0 any rows", F.col("n") > 0)
    if "split" in images.columns:
        least = images.groupBy(_split().alias("split")).agg(F.count("*").alias("k")).agg(F.coalesce(F.min("k"), F.lit(0)).alias("least"))
        rows = rows.union(row(n.crossJoin(least), "I1 rows per split", F.col("least") >= MIN_ROWS))
    else:
        rows = rows.union(row(n, "I1 rows per split", F.lit(False)))
    rows = rows.union(row(n, "I2 columns", F.lit(not missing)))
    if not missing:
        blank = (strip(F.coalesce("transcription", F.lit(""))) == "").cast("bigint")
        a = images.agg(F.count("*").alias("n"), F.sum(blank).alias("blank"))
        ok = (F.col("height").between(16, 512) & F.col("width").between(32, 4096)).cast("bigint")
        s = header_sizes(images).where("width is not null").agg(F.count("*").alias("k"), F.sum(ok).alias("inside"))
        share = lambda x, k: F.coalesce(F.try_divide(F.col(x), F.col(k)), F.lit(None))
        rows = rows.union(row(a, "I4 blank transcriptions", F.coalesce(share("blank", "n") <= MAX_BLANK, F.lit(False)))).union(row(n.crossJoin(s), "I5 sizes", F.coalesce(share("inside", "k") >= MIN_INSIDE, F.lit(False))))
    status = F.when((F.col("n") == 0) & (F.col("check_name") != "I0 any rows"), "SKIP").when(F.col("passed"), "PASS").otherwise("FAIL")
    each = rows.select("check_name", status.alias("status"), F.when((F.col("n") == 0) | F.col("passed"), 0).otherwise(1).alias("exit_code"))
    whole = rows.agg(F.max("n").alias("n"), F.bool_and("passed").alias("passed")).select(F.lit("all"), F.when(F.col("n") == 0, "SKIP").when(F.col("passed"), "PASS").otherwise("FAIL"), F.when((F.col("n") == 0) | F.col("passed"), 0).otherwise(1))
    return each.union(whole)


_PIX = "pix as (select vec_id, label, list_transform(embedding, lambda x: cast(floor((cast(x as double) + 1) * 127.5) as int)) as p from embeddings)"
_PIXSTAT = f"{_PIX}, st as (select vec_id, label, p, list_avg(p) as mean, sqrt(list_avg(list_transform(p, lambda x: x * x)) - list_avg(p) * list_avg(p)) as std, len(list_filter(p, lambda x: x > 240)) / cast(len(p) as double) as white from pix)"


def _pixels(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings")
    p = e.select("vec_id", "label", F.transform("embedding", lambda x: F.floor((x.cast("double") + 1) * 127.5).cast("int")).alias("p"))
    total = F.aggregate("p", F.lit(0).cast("bigint"), lambda a, x: a + x)
    squares = F.aggregate("p", F.lit(0).cast("bigint"), lambda a, x: a + x * x)
    n = F.size("p").cast("double")
    p = p.withColumn("mean", total / n)
    return p.withColumn("std", F.sqrt(squares / n - F.col("mean") * F.col("mean"))).withColumn("white", F.size(F.filter("p", lambda x: x > 240)) / n)


@CORE.add("ahash_near_dups", f"with {_PIXSTAT}, h as (select label, array_to_string(list_transform(p, lambda x: case when x > mean then '1' else '0' end), '') as hash from st) select label, count(*) as n, count(*) - count(distinct hash) as n_duplicates from h group by 1")
def ahash_near_dups(spark, sf_dir):
    """I10 A05 Q-DUP: near duplicates by average hash, for each label."""
    bits = F.concat_ws("", F.transform("p", lambda x: F.when(x > F.col("mean"), "1").otherwise("0")))
    h = _pixels(spark, sf_dir).select("label", bits.alias("hash"))
    per = h.groupBy("label", "hash").agg(F.count("*").alias("k"))
    return per.groupBy("label").agg(F.sum("k").alias("n"), F.sum(F.col("k") - 1).alias("n_duplicates"))


@CORE.add("blank_images", f"with {_PIXSTAT} select label, count(*) as n, count(*) filter (where std < 5.0 or white > 0.95) as n_blank, round(avg(round(mean, 2)), 4) as mean_of_means, round(avg(round(std, 2)), 4) as mean_of_stds from st group by 1")
def blank_images(spark, sf_dir):
    """Q-BLANK A06 A14: blank pictures and means of rounded statistics, for each label."""
    p = _pixels(spark, sf_dir)
    blank = ((F.col("std") < 5.0) | (F.col("white") > 0.95)).cast("bigint")
    return p.groupBy("label").agg(F.count("*").alias("n"), F.sum(blank).alias("n_blank"), F.round(F.avg(F.round("mean", 2)), 4).alias("mean_of_means"), F.round(F.avg(F.round("std", 2)), 4).alias("mean_of_stds"))


@CORE.add(
    "split_drift",
    f"with {_PIXSTAT}, s as (select label % 5 as base, label >= 5 as augmented, avg(mean) as mean, avg(std) as std from st group by 1, 2) select a.base, round(abs(a.mean - b.mean) / 255, 6) as mean_drift, round(abs(a.std - b.std) / 255, 6) as std_drift, abs(a.mean - b.mean) / 255 <= 0.15 as passed from s a join s b on a.base = b.base and not a.augmented and b.augmented",
)
def split_drift(spark, sf_dir):
    """Q-DRIFT J06: drift of brightness between a split and its augmented one (labels l and l + 5)."""
    p = _pixels(spark, sf_dir).groupBy((F.col("label") % 5).alias("base")).agg(*(F.avg(F.when((F.col("label") >= 5) == aug, F.col(c))).alias(f"{c}_{k}") for c in ("mean", "std") for k, aug in (("a", False), ("b", True))))
    d = lambda c: F.abs(F.col(f"{c}_a") - F.col(f"{c}_b")) / 255
    return p.where("mean_a is not null and mean_b is not null").select("base", F.round(d("mean"), 6).alias("mean_drift"), F.round(d("std"), 6).alias("std_drift"), (d("mean") <= 0.15).alias("passed"))


_MMD = """v as (select vec_id, label < 5 as ref, vec_id // 100 as b, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings),
r as (select *, row_number() over (partition by ref, b order by vec_id) as rn from v),
x as (select a.b, (a.rn - 1) // 2 as k, a.e as x1, c.e as x2 from r a join r c on a.ref and c.ref and a.b = c.b and a.rn % 2 = 1 and c.rn = a.rn + 1),
y as (select a.b, (a.rn - 1) // 2 as k, a.e as y1, c.e as y2 from r a join r c on not a.ref and not c.ref and a.b = c.b and a.rn % 2 = 1 and c.rn = a.rn + 1),
h as (select exp(-(list_dot_product(x1, x1) + list_dot_product(x2, x2) - 2 * list_dot_product(x1, x2)) / 2) + exp(-(list_dot_product(y1, y1) + list_dot_product(y2, y2) - 2 * list_dot_product(y1, y2)) / 2)
  - exp(-(list_dot_product(x1, x1) + list_dot_product(y2, y2) - 2 * list_dot_product(x1, y2)) / 2) - exp(-(list_dot_product(x2, x2) + list_dot_product(y1, y1) - 2 * list_dot_product(x2, y1)) / 2) as h from x join y using (b, k))"""


@CORE.add("mmd_drift", f"with {_MMD} select count(*) as n_pairs, round(avg(h), 6) as mmd, round(stddev_samp(h) / sqrt(count(*)), 6) as standard_error, avg(h) > 1.96 * stddev_samp(h) / sqrt(count(*)) as drift from h")
def mmd_drift(spark, sf_dir):
    """The linear-time maximum mean discrepancy (Gretton et al. 2012) between labels below 5 and the rest.

    Each side is paired within blocks of ids, so the cost is linear and no pair of all rows is ever formed.
    """
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", (F.col("label") < 5).alias("ref"), F.expr("vec_id div 100").alias("b"), "embedding")
    w = Window.partitionBy("ref", "b").orderBy("vec_id")
    r = e.withColumn("rn", F.row_number().over(w)).withColumn("k", F.expr("(rn - 1) div 2"))
    two = r.groupBy("ref", "b", "k").agg(F.max(F.when(F.col("rn") % 2 == 1, F.col("embedding"))).alias("p"), F.max(F.when(F.col("rn") % 2 == 0, F.col("embedding"))).alias("q")).where("q is not null")
    x, y = two.where("ref").select("b", "k", F.col("p").alias("x1"), F.col("q").alias("x2")), two.where("not ref").select("b", "k", F.col("p").alias("y1"), F.col("q").alias("y2"))

    def kernel(a, b):
        a, b = F.col(a), F.col(b)
        return F.exp(-(dot(a, a) + dot(b, b) - 2 * dot(a, b)) / 2)

    h = x.join(y, ["b", "k"]).select((kernel("x1", "x2") + kernel("y1", "y2") - kernel("x1", "y2") - kernel("x2", "y1")).alias("h"))
    se = F.stddev_samp("h") / F.sqrt(F.count("*"))
    return h.agg(F.count("*").alias("n_pairs"), F.round(F.avg("h"), 6).alias("mmd"), F.round(se, 6).alias("standard_error"), (F.avg("h") > 1.96 * se).alias("drift"))


_K = "exp(-(list_dot_product({0}.e, {0}.e) + list_dot_product({1}.e, {1}.e) - 2 * list_dot_product({0}.e, {1}.e)) / 2)"
_MMD_ALL = f"""v as (select label < 5 as ref, row_number() over (partition by label < 5 order by vec_id) - 1 as rn, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings where label is not null),
c as (select count(*) filter (ref) as n_ref, count(*) filter (not ref) as n_new from v),
r as (select ref, rn % nb as b, rn // nb as j, count(*) over (partition by ref, rn % nb) as m, e from v, (select greatest(1, least(n_ref, n_new) // 4) as nb from c)),
s as (select a.b, a.ref, avg({_K.format("a", "z")}) as k from r a join r z on a.ref = z.ref and a.b = z.b and z.j = (a.j + 1) % a.m and z.j <> a.j group by 1, 2),
x as (select a.b, avg({_K.format("a", "z")}) as k from r a join r z on a.ref <> z.ref and a.b = z.b and z.j = a.j % z.m and (a.m > z.m or a.m = z.m and a.ref) group by 1),
h as (select p.k + q.k - 2 * x.k as h from x join s p on p.b = x.b and p.ref join s q on q.b = x.b and not q.ref)"""


@CORE.add("mmd_drift_all", f"with {_MMD_ALL} select (select n_ref from c) as n_ref, (select n_new from c) as n_new, count(*) as n_blocks, round(avg(h), 6) as mmd, round(stddev_samp(h) / sqrt(count(*)), 6) as standard_error, avg(h) > 1.96 * stddev_samp(h) / sqrt(count(*)) as drift from h")
def mmd_drift_all(spark, sf_dir):
    """The discrepancy of mmd_drift from every labelled vector, however the ids of the two sides lie."""
    return discrepancy(read_table(spark, sf_dir, "embeddings").where("label is not null").select("vec_id", (F.col("label") < 5).alias("ref"), "embedding"))


def discrepancy(vectors):
    """``n_ref, n_new, n_blocks, mmd, standard_error, drift`` of ``vectors``: vec_id, ref (which side), embedding.

    Each side is numbered by itself and dealt out to the same blocks, at least four rows of the smaller side in each.
    In a block every row meets the next of its side, and every row of the larger side one of the smaller, so the
    kernel means of a block see all its rows at linear cost; the error comes from how blocks differ.
    """
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = stage(vectors.repartitionByRange(n, "ref", "vec_id").withColumn("part", F.spark_partition_id()))
    local = parts.withColumn("k", F.row_number().over(Window.partitionBy("part", "ref").orderBy("vec_id")))
    sizes = parts.groupBy("ref", "part").agg(F.count("*").alias("c"))
    before = sizes.withColumn("off", F.coalesce(F.sum("c").over(Window.partitionBy("ref").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("c")
    total = sizes.agg(*(F.coalesce(F.sum(F.when(F.col("ref") == side, F.col("c"))), F.lit(0)).alias(c) for c, side in (("n_ref", True), ("n_new", False))))
    nb = F.greatest(F.lit(1), F.expr("least(n_ref, n_new) div 4"))
    r = local.join(before, ["ref", "part"]).crossJoin(F.broadcast(total)).withColumn("nb", nb).withColumn("rn", F.col("k") + F.col("off") - 1)
    r = r.withColumn("b", F.col("rn") % F.col("nb")).withColumn("j", F.expr("rn div nb"))
    in_block = lambda c: F.expr(f"({c} - b + nb - 1) div nb")
    r = r.withColumn("m", F.when(F.col("ref"), in_block("n_ref")).otherwise(in_block("n_new"))).withColumn("other", F.when(F.col("ref"), in_block("n_new")).otherwise(in_block("n_ref")))
    r = r.select("ref", "b", "j", "m", "other", F.col("embedding").alias("e"))
    z = r.select(F.col("ref").alias("z_ref"), F.col("b").alias("z_b"), F.col("j").alias("z_j"), F.col("e").alias("z_e"))
    kernel = F.exp(-(dot(F.col("e"), F.col("e")) + dot(F.col("z_e"), F.col("z_e")) - 2 * dot(F.col("e"), F.col("z_e"))) / 2)
    same = r.withColumn("next", (F.col("j") + 1) % F.col("m")).join(z, (F.col("ref") == F.col("z_ref")) & (F.col("b") == F.col("z_b")) & (F.col("next") == F.col("z_j"))).where("j <> next")
    wide = r.where("other > 0 and (m > other or m = other and ref)").withColumn("mate", F.col("j") % F.greatest("other", F.lit(1))).withColumn("far", ~F.col("ref"))
    cross = wide.join(z, (F.col("far") == F.col("z_ref")) & (F.col("b") == F.col("z_b")) & (F.col("mate") == F.col("z_j")))
    s = same.groupBy("b").agg(F.avg(F.when(F.col("ref"), kernel)).alias("kx"), F.avg(F.when(~F.col("ref"), kernel)).alias("ky")).where("kx is not null and ky is not null")
    h = cross.groupBy("b").agg(F.avg(kernel).alias("kxy")).join(s, "b").select((F.col("kx") + F.col("ky") - 2 * F.col("kxy")).alias("h"))
    se = F.stddev_samp("h") / F.sqrt(F.count("*"))
    of_h = h.agg(F.count("*").alias("n_blocks"), F.round(F.avg("h"), 6).alias("mmd"), F.round(se, 6).alias("standard_error"), (F.avg("h") > 1.96 * se).alias("drift"))
    return total.crossJoin(of_h)


@CORE.add(
    "enum_checks",
    """select 'documents.source' as column_name, count(*) filter (where source is null or source not in ('user_upload', 'synthetic', 'test')) as n_bad from documents
    union all select 'search_feedback.feedback_type', count(*) filter (where feedback_type is null or feedback_type not in ('click', 'thumbs_up', 'thumbs_down')) from search_feedback""",
)
def enum_checks(spark, sf_dir):
    """Q-CHK: values outside the declared sets."""
    bad = lambda t, c, ok: read_table(spark, sf_dir, t).agg(F.sum((~F.coalesce(F.col(c).isin(*ok), F.lit(False))).cast("bigint")).alias("n_bad")).select(F.lit(f"{t}.{c}").alias("column_name"), F.coalesce("n_bad", F.lit(0)).alias("n_bad"))
    return bad("documents", "source", ("user_upload", "synthetic", "test")).union(bad("search_feedback", "feedback_type", ("click", "thumbs_up", "thumbs_down")))


@CORE.add("repeated_rows", "select 'corrections' as tab, count(*) - count(distinct correction_id) as n_repeated from corrections union all select 'query_sessions', count(*) - count(distinct id) from query_sessions union all select 'search_feedback', count(*) - count(distinct id) from search_feedback union all select 'document_pages', count(*) - count(distinct id) from document_pages union all select 'handwritten_regions', count(*) - count(distinct id) from handwritten_regions")
def repeated_rows(spark, sf_dir):
    """Unique keys are asserted, not assumed: rows delivered again, for each table."""
    keys = (("corrections", "correction_id"), ("query_sessions", "id"), ("search_feedback", "id"), ("document_pages", "id"), ("handwritten_regions", "id"))
    out = None
    for t, k in keys:
        one = read_table(spark, sf_dir, t).groupBy(k).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - F.when(F.col(k).isNull(), 0).otherwise(1)), F.lit(0)).alias("n_repeated")).select(F.lit(t).alias("tab"), "n_repeated")
        out = one if out is None else out.union(one)
    return out


_RASTER = f"{_PIX}, k as (select vec_id, list_transform(p, lambda x: case when x < 110 then 1 else 0 end) as k from pix)"


@CORE.add("ink_profiles", f"with {_RASTER} select vec_id, array_to_string(list_transform(range(0, 8), lambda y: cast(list_sum(k[y * 8 + 1 : y * 8 + 8]) as int)), ',') as by_row, array_to_string(list_transform(range(0, 8), lambda x: cast(list_sum(list_transform(range(0, 8), lambda y: k[y * 8 + x + 1])) as int)), ',') as by_column from k")
def ink_profiles(spark, sf_dir):
    """Dark pixels of each row and column of the small rasters."""
    k = _pixels(spark, sf_dir).select("vec_id", F.transform("p", lambda x: (x < 110).cast("int")).alias("k"))
    add = lambda parts: F.aggregate(parts, F.lit(0), lambda a, x: a + x)
    eight = F.sequence(F.lit(0), F.lit(7))
    by_row = F.transform(eight, lambda y: add(F.slice("k", y * 8 + 1, F.lit(8))))
    by_column = F.transform(eight, lambda x: add(F.transform(eight, lambda y: F.element_at("k", (y * 8 + x + 1).cast("int")))))
    return k.select("vec_id", F.array_join(by_row.cast("array<string>"), ",").alias("by_row"), F.array_join(by_column.cast("array<string>"), ",").alias("by_column"))


@CORE.add("pixel_medians", f"with {_PIX} select vec_id, cast(list_aggregate(p, 'median') as double) as median from pix")
def pixel_medians(spark, sf_dir):
    """The median pixel of each small raster; the mean of the middle two where their number is even."""
    p = _pixels(spark, sf_dir).select("vec_id", F.sort_array("p").alias("s"))
    n = F.size("s")
    low, high = F.floor((n + 1) / 2).cast("int"), F.floor((n + 2) / 2).cast("int")
    return p.select("vec_id", ((F.element_at("s", low) + F.element_at("s", high)) / F.lit(2.0)).alias("median"))
