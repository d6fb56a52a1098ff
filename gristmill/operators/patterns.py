"""Pattern records: building, reading three layouts, ranking, table cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.once import computed_once
from gristmill.functions.text import CONTEXT_TEMPLATE, SYSTEM_MESSAGE, USER_MESSAGE
from gristmill.operators.boards import metric_columns, number_text
from gristmill.operators.ranking import global_rank

# Defaults of a pattern record.
DEFAULTS = {"datasource_type": "ls_milvus", "chunking_method": "recursive", "chunk_size": 2048,
            "chunk_overlap": 256, "distance_metric": "cosine", "embedding_dimension": 768,
            "retrieval_method": "simple", "number_of_chunks": 5}
# Leaderboard columns, their other names, and empty cells.
PREFERRED_METRICS = ("answer_correctness", "faithfulness", "context_correctness")
CONFIG_COLUMNS = ("chunking.method", "chunking.chunk_size", "chunking.chunk_overlap",
                  "embeddings.model_id", "retrieval.method", "retrieval.number_of_chunks",
                  "retrieval.search_mode", "retrieval.ranker_strategy", "generation.model_id")
OTHER_NAMES = {"embeddings.model_id": ("embedding_model", "embedding.model_id"),
               "generation.model_id": ("foundation_model",)}
NO_RANKER = "-"
NO_NAME = "—"
METRIC_PREFIX = "mean_"


def build_pattern(df: DataFrame) -> Column:
    """A full pattern record from whichever flat columns ``df`` has.

    Missing settings take their defaults; optional retrieval fields stay null
    and are left out when the record is written as JSON.
    """
    def given(name: str, kind: str) -> Column:
        return F.col(name).cast(kind) if name in df.columns else F.lit(None).cast(kind)

    def setting(name: str, kind: str) -> Column:
        default = DEFAULTS.get(name, "")
        return F.coalesce(given(name, kind), F.lit(default).cast(kind))

    def text(name: str, default: str) -> Column:
        return F.coalesce(given(name, "string"), F.lit(default)).alias(name)

    vector_store = F.struct(setting("datasource_type", "string").alias("datasource_type"),
                            setting("collection_name", "string").alias("collection_name"))
    chunking = F.struct(setting("chunking_method", "string").alias("method"),
                        setting("chunk_size", "int").alias("chunk_size"),
                        setting("chunk_overlap", "int").alias("chunk_overlap"))
    embedding = F.struct(
        setting("embedding_model", "string").alias("model_id"),
        setting("distance_metric", "string").alias("distance_metric"),
        F.struct(setting("embedding_dimension", "int").alias("embedding_dimension")
                 ).alias("embedding_params"))
    retrieval = F.struct(
        setting("retrieval_method", "string").alias("method"),
        setting("number_of_chunks", "int").alias("number_of_chunks"),
        given("search_mode", "string").alias("search_mode"),
        given("ranker_strategy", "string").alias("ranker_strategy"),
        given("ranker_k", "int").alias("ranker_k"),
        given("ranker_alpha", "double").alias("ranker_alpha"))
    generation = F.struct(
        setting("generation_model", "string").alias("model_id"),
        text("context_template_text", CONTEXT_TEMPLATE), text("user_message_text", USER_MESSAGE),
        text("system_message_text", SYSTEM_MESSAGE))
    settings = F.struct(vector_store.alias("vector_store"), chunking.alias("chunking"),
                        embedding.alias("embedding"), retrieval.alias("retrieval"),
                        generation.alias("generation"))
    return F.struct(
        setting("name", "string").alias("name"),
        F.coalesce(given("iteration", "int"), F.lit(0)).alias("iteration"),
        F.coalesce(given("max_combinations", "int"), F.lit(24)).alias("max_combinations"),
        F.coalesce(given("duration_seconds", "double"), F.lit(0.0)).alias("duration_seconds"),
        settings.alias("settings"))


def _read(variant: Column, *keys: str) -> Column:
    path = "$" + "".join(f"['{key}']" for key in keys)
    return F.try_variant_get(variant, path, "string")


def _filled(text: Column) -> Column:
    """Null for what counts as absent: empty text, empty object or list, zero, false."""
    return F.when(~text.isin("", "{}", "[]", "0", "0.0", "false"), text)


def config_value(params: Column, column: str) -> Column:
    """Value of a dotted name: a flat key, a nested key, then its other names."""
    found = []
    for name in (column, *OTHER_NAMES.get(column, ())):
        found.append(_read(params, name))
        if "." in name:
            found.append(_read(params, *name.split(".", 1)))
    return F.coalesce(*found)


def _only_text(variant: Column, *keys: str) -> Column:
    """A value that is a JSON string; numbers and objects do not count."""
    path = "$" + "".join(f"['{key}']" for key in keys)
    part = F.try_variant_get(variant, path, "variant")
    return F.when(F.schema_of_variant(part) == "STRING", _read(variant, *keys))


def _layout(pattern: Column) -> Column:
    return F.when(_filled(_read(pattern, "rag_pattern", "settings")).isNotNull(), "legacy").when(
        _filled(_read(pattern, "settings")).isNotNull(), "flat").otherwise("split")


def _config_columns(pattern: Column, layout: Column) -> dict[str, Column]:
    """The nine settings from whichever of the three layouts a record has."""
    legacy, flat = layout == "legacy", layout == "flat"
    rag = F.try_variant_get(pattern, "$.rag_params", "variant")
    indexing = F.try_variant_get(pattern, "$.indexing_params", "variant")

    def old(*keys):
        return _read(pattern, "rag_pattern", "settings", *keys)

    def new(*keys):
        return _read(pattern, "settings", *keys)

    embedding = F.when(_filled(new("embedding")).isNotNull(), new("embedding", "model_id")
                       ).otherwise(new("embeddings", "model_id"))
    columns = {}
    for column in CONFIG_COLUMNS:
        section, field = column.split(".")
        if section == "chunking":
            from_old, from_new = old(section, field), new(section, field)
        elif section == "embeddings":
            from_old = old("embedding", "model_id")
            from_new = F.coalesce(embedding, _only_text(pattern, "settings", "embedding_model"))
        elif section == "generation":
            from_old = old("generation", "model_id")
            from_new = F.coalesce(new("generation", "model_id"),
                                  _only_text(pattern, "settings", "foundation_model"))
        else:
            from_old = old(field) if field in ("method", "number_of_chunks") else F.lit(None)
            from_new = new(section, field)
        # In the oldest layout a section of the second object replaces the first's.
        replaced = F.try_variant_get(rag, f"$['{section}']", "variant").isNotNull()
        merged = F.coalesce(_read(rag, column), _read(indexing, column), F.when(
            replaced, _read(rag, section, field)).otherwise(_read(indexing, section, field)))
        for name in OTHER_NAMES.get(column, ()):
            merged = F.coalesce(merged, config_value(rag, name), config_value(indexing, name))
        columns[column] = F.when(legacy, from_old).when(flat, from_new).otherwise(merged)
    return columns


def normalize_pattern(df: DataFrame, json: str = "pattern", keep: tuple[str, ...] = ()) -> DataFrame:
    """Typed columns from pattern JSON: name, score, metric means, nine settings.

    ``means`` keeps the metrics in the order they are written.
    """
    read = computed_once(df.select(*keep, json), "_v", F.try_parse_json(json))
    read = computed_once(read, "_layout", _layout(F.col("_v")))
    raw = F.get_json_object(json, "$.scores")
    nested = F.get_json_object(json, "$.scores.scores")
    scores = F.from_json(F.when(F.startswith(nested, F.lit("{")), nested).otherwise(raw),
                         "map<string,string>")
    means = F.filter(F.transform(F.map_entries(scores), lambda e: F.struct(
        e["key"].alias("metric"),
        F.get_json_object(e["value"], "$.mean").try_cast("double").alias("mean"))),
        lambda e: e["metric"].isNotNull())
    variant = F.col("_v")
    named = F.coalesce(_filled(_read(variant, "name")), _filled(_read(variant, "pattern_name")),
                       _read(variant, "rag_pattern", "name"), F.lit(NO_NAME))
    return read.select(
        *keep, named.alias("name"),
        F.try_variant_get(variant, "$.final_score", "string").try_cast("double")
        .alias("final_score"),
        F.coalesce(means, F.array().cast("array<struct<metric:string,mean:double>>"))
        .alias("means"),
        *[value.alias(column) for column, value in _config_columns(
            variant, F.col("_layout")).items()])


def pattern_order(patterns: DataFrame, directory: str) -> DataFrame:
    """Rank by final score, else by the first metric that has a mean; neither
    goes last; ties keep directory order."""
    first = F.get(F.filter("means", lambda e: e["mean"].isNotNull()), F.lit(0))["mean"]
    score = F.coalesce("final_score", first)
    ordered = patterns.withColumn("_missing", score.isNull()).withColumn(
        "_order", F.coalesce(-score, F.lit(0.0)))
    return global_rank(ordered, ["_missing", "_order", directory]).drop("_missing", "_order")


def leaderboard_table(ranked: DataFrame, metric: str = "faithfulness") -> DataFrame:
    """Text cells: rank, name, metric means to four places, settings.

    Only metric names reach the driver, to lay out the columns.
    """
    seen = ranked.select("rank", F.posexplode("means").alias("place", "entry")).groupBy(
        F.col("entry.metric").alias("metric")).agg(F.min(F.struct("rank", "place")).alias("at"))
    present = [row["metric"] for row in seen.orderBy("at").collect()]
    cells = [F.col("rank"), F.col("name").alias("Pattern_Name")]
    by_name = F.map_from_entries(F.array_distinct(F.filter(
        "means", lambda e: e["mean"].isNotNull())))
    for name in metric_columns(present, metric, PREFERRED_METRICS):
        mean = F.try_element_at(by_name, F.lit(name))
        cells.append(F.when(mean.isNotNull(), number_text(mean)).otherwise("")
                     .alias(f"{METRIC_PREFIX}{name}"))
    for column in CONFIG_COLUMNS:
        value = F.col(f"`{column}`")
        if column == "retrieval.ranker_strategy":
            cells.append(F.when(value != "", value).otherwise(NO_RANKER).alias(column))
        else:
            cells.append(F.coalesce(value, F.lit("")).alias(column))
    return ranked.select(*cells)
