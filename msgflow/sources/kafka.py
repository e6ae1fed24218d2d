"""Kafka scans and the client properties that configure them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

SASL_PROTOCOLS = ("SASL_SSL", "SASL_PLAINTEXT")

# The words that client libraries accept for auto.offset.reset, by the two that Spark's source knows.
START_WORDS = {"earliest": ("earliest", "smallest", "beginning"), "latest": ("latest", "largest", "end")}

# Client settings that Spark's source decides itself, or that are translated below.
_NOT_PASSED_ON = {
    "auto.offset.reset",
    "enable.auto.commit",
    "group.id",
    "sasl.mechanism",
    "sasl.mechanisms",
    "sasl.password",
    "sasl.username",
}


def parse_properties(lines: Iterable[str]) -> dict[str, str]:
    """``key=value`` lines; the first ``=`` splits, blank lines and ``#`` comments are skipped."""
    stripped = (line.strip() for line in lines)
    pairs = (line.partition("=") for line in stripped if "=" in line and not line.startswith("#"))
    return {key.strip(): value.strip() for key, _, value in pairs}


def read_properties(path: str) -> dict[str, str]:
    with open(path, encoding="utf-8") as lines:
        return parse_properties(lines)


def _mechanism(properties: Mapping[str, str]) -> str | None:
    return properties.get("sasl.mechanisms", properties.get("sasl.mechanism"))


def validate_properties(properties: Mapping[str, str], require: Iterable[str] = ()) -> None:
    """Raise ValueError for a missing setting; the SASL protocols need mechanism, user and password."""
    missing = [name for name in ("bootstrap.servers", *require) if name not in properties]
    if properties.get("security.protocol", "PLAINTEXT").upper() in SASL_PROTOCOLS:
        if _mechanism(properties) is None:
            missing.append("sasl.mechanisms")
        missing += [name for name in ("sasl.username", "sasl.password") if name not in properties]
    if missing:
        raise ValueError(f"missing Kafka settings: {', '.join(missing)}")


def _login(mechanism: str, user: str, password: str) -> str:
    module = "scram.ScramLoginModule" if mechanism.upper().startswith("SCRAM") else "plain.PlainLoginModule"
    quoted = [text.replace("\\", "\\\\").replace('"', '\\"') for text in (user, password)]
    return (
        f"org.apache.kafka.common.security.{module} required "
        f'username="{quoted[0]}" password="{quoted[1]}";'
    )


def _start(word: str) -> str:
    """The source's word for where a client property says to start."""
    for start, words in START_WORDS.items():
        if word.strip().lower() in words:
            return start
    raise ValueError(f"auto.offset.reset can not be {word!r} here: one of {', '.join(w for ws in START_WORDS.values() for w in ws)}")


def kafka_options(
    properties: Mapping[str, str],
    topic: str,
    *,
    starting_offsets: str | None = None,
    fail_on_data_loss: bool = True,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    use_group_id: bool = False,
    secure_defaults: bool = False,
    require: Iterable[str] = (),
) -> dict[str, str]:
    """Client properties as options of Spark's Kafka source.

    ``starting_offsets`` counts only for the first run of a query, later runs go on from the
    checkpoint; where it is not given, ``auto.offset.reset`` decides, else ``earliest``.
    ``secure_defaults`` puts SASL_SSL with PLAIN below the given properties. ``min_partitions``
    splits large Kafka partitions over several tasks, so one hot partition does not hold up a batch.
    """
    if secure_defaults:
        properties = {"security.protocol": "SASL_SSL", "sasl.mechanisms": "PLAIN", **properties}
        if "sasl.mechanism" in properties:
            properties["sasl.mechanisms"] = properties["sasl.mechanism"]
    validate_properties(properties, require)
    options = {f"kafka.{k}": v for k, v in properties.items() if k not in _NOT_PASSED_ON}
    options["subscribe"] = topic
    options["startingOffsets"] = starting_offsets or _start(properties.get("auto.offset.reset", "earliest"))
    options["failOnDataLoss"] = str(fail_on_data_loss).lower()
    if properties.get("security.protocol", "").upper() in SASL_PROTOCOLS:
        mechanism = _mechanism(properties)
        options["kafka.sasl.mechanism"] = mechanism
        options.setdefault(
            "kafka.sasl.jaas.config",
            _login(mechanism, properties["sasl.username"], properties["sasl.password"]),
        )
    if use_group_id and "group.id" in properties:
        options["kafka.group.id"] = properties["group.id"]
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return options


def kafka_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def kafka_batch(spark: SparkSession, options: Mapping[str, str], ending_offsets: str = "latest") -> DataFrame:
    """Bounded read of the same topic, as the topic profile and the schema sample need it."""
    bounded = {k: v for k, v in options.items() if k != "maxOffsetsPerTrigger"}
    if bounded.get("startingOffsets") == "latest":
        bounded["startingOffsets"] = "earliest"
    return spark.read.format("kafka").options(**bounded, endingOffsets=ending_offsets).load()
