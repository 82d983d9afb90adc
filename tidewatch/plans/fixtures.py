"""Clinical tables derived from the driver's star-schema and event tables.

Time is compressed tenfold so that patients have hours with both measures. Raw columns are
strings built from integers, because engines print doubles differently. Faulty rows (bad
numbers, bad times, missing keys, wrong units) are planted by id so that the gates have work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions.hashing import hash32

START = "2024-01-01 00:00:00"
STAY_SECONDS = 129600


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def at(seconds: Column) -> Column:
    """Seconds since the start as a timestamp without zone."""
    return F.timestamp_add("SECOND", seconds, F.lit(START).cast("timestamp_ntz"))


def printed(seconds: Column) -> Column:
    return F.date_format(at(seconds), "yyyy-MM-dd HH:mm:ss")


def _milli(value: Column) -> Column:
    return F.lit(800) + F.floor(F.round(value * 100) / 10).cast("bigint")


def _fixed3(milli: Column) -> Column:
    return F.concat(
        F.floor(milli / 1000).cast("bigint").cast("string"),
        F.lit("."),
        F.lpad((milli % 1000).cast("string"), 3, "0"),
    )


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def timed_events(source: DataFrame) -> DataFrame:
    """The events table, batch or stream, with compressed seconds and a milli-value."""
    seconds = F.timestamp_diff("SECOND", F.lit(START).cast("timestamp_ntz"), F.col("ts"))
    return source.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.floor(seconds / 10).cast("bigint").alias("sec"),
        _milli(F.col("value")).alias("milli"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed_events(table(spark, sf_dir, "events"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("user_id").distinct()


def stays_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("user_id")
    begin = F.col("k") * STAY_SECONDS + (u % 5) * 3600
    length = (
        F.when(_every("user_id", 17) & (F.col("k") == 1), 0)
        .when(_every("user_id", 7) & (F.col("k") == 0), STAY_SECONDS)
        .otherwise(108000)
        .cast("bigint")
    )
    return (
        users(spark, sf_dir)
        .select("user_id", F.explode(F.array(F.lit(0), F.lit(1)).cast("array<bigint>")).alias("k"))
        .select(
            u.cast("string").alias("subject_id"),
            (u * 10).cast("string").alias("hadm_id"),
            (u * 10 + F.col("k")).cast("string").alias("stay_id"),
            F.when(u % 2 == 0, "MICU").otherwise("SICU").alias("first_careunit"),
            F.when(u % 3 == 0, "MICU").otherwise("SICU").alias("last_careunit"),
            printed(begin).alias("intime"),
            printed(begin + length).alias("outtime"),
            _fixed3(F.floor(length * 10 / 864).cast("bigint")).alias("los"),
        )
    )


def labs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).filter(F.col("event_type").isin("purchase", "signup", "error"))
    u = F.col("user_id")
    item = (
        F.when(F.col("event_type") == "purchase", "50912")
        .when(F.col("event_type") == "signup", "51081")
        .otherwise("50971")
    )
    number = (
        F.when(_every("event_id", 97), "PENDING")
        .when(_every("event_id", 89), F.lit(None).cast("string"))
        .when(_every("event_id", 83), "25.000")
        .otherwise(_fixed3(F.col("milli")))
    )
    return rows.select(
        F.col("event_id").cast("string").alias("labevent_id"),
        u.cast("string").alias("subject_id"),
        F.when(~_every("event_id", 53), (u * 10).cast("string")).alias("hadm_id"),
        item.alias("itemid"),
        F.when(_every("event_id", 101), "not a time").otherwise(printed(F.col("sec"))).alias("charttime"),
        number.alias("valuenum"),
        F.when(_every("event_id", 41), "umol/L").otherwise("mg/dL").alias("valueuom"),
    )


def outputs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).filter(F.col("event_type").isin("view", "click"))
    u = F.col("user_id")
    item = (
        F.when(_every("event_id", 29), "227488")
        .when(F.col("event_type") == "view", "226559")
        .otherwise("226560")
    )
    number = (
        F.when(_every("event_id", 79), "-5")
        .when(_every("event_id", 73), "12000")
        .otherwise(F.round("value").cast("bigint").cast("string"))
    )
    return rows.select(
        u.cast("string").alias("subject_id"),
        (u * 10).cast("string").alias("hadm_id"),
        (u * 10 + F.when(F.col("sec") < STAY_SECONDS, 0).otherwise(1)).cast("string").alias("stay_id"),
        printed(F.col("sec")).alias("charttime"),
        item.alias("itemid"),
        number.alias("value"),
        F.lit("mL").alias("valueuom"),
    )


def admissions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("user_id")
    begin = (u % 5) * 3600
    end = F.when(_every("user_id", 23), begin).otherwise(begin + 3 * STAY_SECONDS)
    return users(spark, sf_dir).select(
        u.cast("string").alias("subject_id"),
        F.when(~_every("user_id", 31), (u * 10).cast("string")).alias("hadm_id"),
        printed(begin).alias("admittime"),
        F.when(~_every("user_id", 43), printed(end)).alias("dischtime"),
    )


def _catalogue(spark: SparkSession, sf_dir: str, first: int) -> DataFrame:
    """Dictionary rows made from the part table, one in fifty carrying a clinical word."""
    p = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        (p + first).alias("itemid"),
        F.when(p % 97 == 0, F.lit(None).cast("string"))
        .when(p % 50 == 1, "Creatinine Clearance")
        .when(p % 50 == 2, "Urine Volume")
        .when(p % 50 == 3, "Avoided Meals")
        .otherwise(F.col("p_name"))
        .alias("label"),
        F.when(p % 50 == 4, "Urine").otherwise(F.col("p_brand")).alias("category"),
    )


def d_labitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.col("itemid")
    used = (
        labs_raw(spark, sf_dir)
        .select(F.col("itemid").cast("bigint").alias("itemid"))
        .distinct()
        .select(
            item,
            F.when(item == 50912, "Creatinine")
            .when(item == 51081, "CREATININE, Serum")
            .otherwise("Potassium")
            .alias("label"),
            F.lit("Chemistry").alias("category"),
        )
    )
    return used.unionByName(_catalogue(spark, sf_dir, 600000))


def d_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.col("itemid")
    used = (
        outputs_raw(spark, sf_dir)
        .select(F.col("itemid").cast("bigint").alias("itemid"))
        .distinct()
        .select(
            item,
            F.when(item == 226559, "Foley")
            .when(item == 226560, "Void")
            .otherwise("GU Irrigant Volume In")
            .alias("label"),
            F.lit("Output").alias("category"),
        )
    )
    return used.unionByName(_catalogue(spark, sf_dir, 700000))


def people_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hospital's patient table, some rows without their key."""
    u = F.col("user_id")
    return users(spark, sf_dir).select(
        F.when(u % 47 != 0, u.cast("string")).alias("subject_id"), F.when(u % 2 == 0, "F").otherwise("M").alias("gender")
    )


def in_long_series(user: Column) -> Column:
    """One patient in ten of the second cohort gets the events of four users, and so more than 48 hours."""
    return F.when((user % 40).between(1, 4), user - user % 40 + 1).otherwise(user)


def patients_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second cohort's demographics: customers who have events."""
    key = F.col("c_custkey")
    return (
        table(spark, sf_dir, "customer")
        .join(users(spark, sf_dir), key == F.col("user_id"), "left_semi")
        .select(
            key.alias("patientunitstayid"),
            F.concat(F.lit("P"), key.cast("string")).alias("uniquepid"),
            F.col("c_nationkey").cast("bigint").alias("hospitalid"),
            F.concat(F.lit("R"), (F.col("c_nationkey") % 5).cast("string")).alias("region"),
            F.col("c_mktsegment").alias("unittype"),
            F.when(key % 59 != 0, (key * 13) % 130).cast("int").alias("age"),
            F.when(key % 2 == 0, "Female").otherwise("Male").alias("gender"),
            F.concat(F.lit("E"), (key % 4).cast("string")).alias("ethnicity"),
            (F.lit(25) + (key * 7) % 240).cast("double").alias("admissionweight"),
            F.concat(F.lit("DX"), (key % 9).cast("string")).alias("apacheadmissiondx"),
        )
    )


def lab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second cohort's labs: minute offsets and untidy names, some of them null."""
    rows = events(spark, sf_dir).filter(F.col("event_type").isin("purchase", "signup", "error"))
    name = (
        F.when(_every("event_id", 67), F.lit(None).cast("string"))
        .when(F.col("event_type") == "purchase", " Creatinine ")
        .when(F.col("event_type") == "signup", "CREATININE")
        .otherwise("sodium")
    )
    return rows.select(
        "event_id",
        in_long_series(F.col("user_id")).alias("patientunitstayid"),
        name.alias("labname"),
        F.floor(F.col("sec") / 60).cast("int").alias("labresultoffset"),
        F.when(_every("event_id", 83), 25.0).otherwise(F.col("milli") / 1000.0).alias("labresult"),
    )


def intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).filter(F.col("event_type").isin("view", "click"))
    return rows.select(
        "event_id",
        in_long_series(F.col("user_id")).alias("patientunitstayid"),
        F.floor(F.col("sec") / 60).cast("int").alias("intakeoutputoffset"),
        F.when(_every("event_id", 79), -5.0)
        .when(_every("event_id", 73), 12000.0)
        .otherwise(F.round("value"))
        .alias("cellvaluenumeric"),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probabilities with ties, zeros and ones, labels drawn with that probability."""
    a = hash32(F.concat(F.lit("p"), F.col("event_id").cast("string"))) % 1001
    draw = hash32(F.concat(F.lit("y"), F.col("event_id").cast("string"))) % 1000
    return (
        table(spark, sf_dir, "events")
        .select(F.col("event_id").alias("id"), "user_id", a.alias("a"), draw.alias("draw"))
        .select(
            "id",
            "user_id",
            (F.col("a") / 1000.0).alias("prob"),
            F.when(F.col("draw") < F.col("a"), 1).otherwise(0).alias("label"),
        )
    )


def as_live(source: DataFrame) -> DataFrame:
    """Live events in arrival order; every 37th is delivered a second time, every 61st has no value."""
    creatinine = F.col("event_type").isin("purchase", "signup")
    urine = F.col("event_type").isin("view", "click")
    copies = F.when(_every("event_id", 37), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (
        timed_events(source)
        .withColumn("copy", F.explode(copies))
        .select(
            (F.col("event_id") + F.col("copy") * 1000000000).cast("bigint").alias("arrival"),
            F.col("user_id").alias("subject_id"),
            (F.col("user_id") * 10).alias("hadm_id"),
            (F.col("user_id") * 10 + F.when(F.col("sec") < STAY_SECONDS, 0).otherwise(1)).alias("stay_id"),
            printed(F.col("sec")).alias("charttime"),
            F.when(creatinine, "creatinine").when(urine, "urine").otherwise("heart_rate").alias("event_type"),
            F.when(_every("event_id", 61), F.lit(None).cast("double"))
            .when(creatinine, F.col("milli") / 1000.0)
            .otherwise(F.round("value"))
            .alias("value"),
            F.when(creatinine, "mg/dL").when(urine, "mL").otherwise("bpm").alias("uom"),
        )
    )


def live_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_live(table(spark, sf_dir, "events"))
