"""Options of the Kafka source. There is no broker or connector here, so nothing is read."""

import pytest
from msgflow.operators import end_offsets
from msgflow.session import KAFKA_PACKAGE, kafka_session, work_folder
from msgflow.sources import kafka_batch, kafka_options, kafka_stream, parse_properties, read_properties
from msgflow.streaming import send

PLAIN = {"bootstrap.servers": "broker:9092"}
SECURE = {
    **PLAIN,
    "security.protocol": "sasl_ssl",
    "sasl.mechanisms": "PLAIN",
    "sasl.username": 'us"er',
    "sasl.password": "p=1",
}


def test_properties(tmp_path):
    text = "# comment\n\n bootstrap.servers = a:1,b:2 \nsasl.password=x=y\nno separator\n"
    (tmp_path / "client.properties").write_text(text)
    expected = {"bootstrap.servers": "a:1,b:2", "sasl.password": "x=y"}
    assert parse_properties(text.splitlines()) == expected
    assert read_properties(str(tmp_path / "client.properties")) == expected
    with pytest.raises(FileNotFoundError):
        read_properties(str(tmp_path / "other.properties"))


def test_plain_options():
    assert kafka_options(PLAIN, "t") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "t",
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }


def test_offsets_limits_and_group():
    properties = {**PLAIN, "auto.offset.reset": "latest", "group.id": "g", "enable.auto.commit": "false"}
    options = kafka_options(
        properties, "t", fail_on_data_loss=False, max_offsets_per_trigger=100, min_partitions=64, use_group_id=True
    )
    assert options["startingOffsets"] == "latest" and options["kafka.group.id"] == "g"
    assert options["failOnDataLoss"] == "false" and options["maxOffsetsPerTrigger"] == "100"
    assert options["minPartitions"] == "64" and "kafka.enable.auto.commit" not in options
    assert kafka_options(properties, "t", starting_offsets="earliest")["startingOffsets"] == "earliest"


@pytest.mark.parametrize("name", ["sasl.mechanisms", "sasl.mechanism"])
def test_secure_options(name):
    properties = dict(SECURE)
    properties[name] = properties.pop("sasl.mechanisms")
    options = kafka_options(properties, "t")
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert options["kafka.sasl.jaas.config"] == (
        "org.apache.kafka.common.security.plain.PlainLoginModule required "
        'username="us\\"er" password="p=1";'
    )
    assert not {"kafka.sasl.username", "kafka.sasl.password"} & set(options)


def test_scram_and_secure_defaults():
    scram = kafka_options({**SECURE, "sasl.mechanisms": "SCRAM-SHA-512"}, "t")
    assert "ScramLoginModule" in scram["kafka.sasl.jaas.config"]
    login = {**PLAIN, "sasl.username": "u", "sasl.password": "p"}
    options = kafka_options(login, "t", secure_defaults=True)
    assert options["kafka.security.protocol"] == "SASL_SSL" and options["kafka.sasl.mechanism"] == "PLAIN"
    other = kafka_options({**login, "sasl.mechanism": "SCRAM-SHA-256"}, "t", secure_defaults=True)
    assert other["kafka.sasl.mechanism"] == "SCRAM-SHA-256"


@pytest.mark.parametrize("missing", ["bootstrap.servers", "sasl.mechanisms", "sasl.username", "sasl.password"])
def test_missing_settings(missing):
    properties = {k: v for k, v in SECURE.items() if k != missing}
    with pytest.raises(ValueError, match=missing):
        kafka_options(properties, "t")


def test_required_group():
    with pytest.raises(ValueError, match="group.id"):
        kafka_options(PLAIN, "t", require=["group.id"])


class Recorder:
    """Stands in for a session and its readers; notes the options a scan is built with."""

    def __init__(self):
        self.seen = {}
        self.read = self.readStream = self

    def format(self, name):
        self.seen["format"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def load(self):
        return self.seen


def test_scans():
    options = kafka_options(PLAIN, "t", starting_offsets="latest", max_offsets_per_trigger=5)
    stream = kafka_stream(Recorder(), options)
    assert stream["format"] == "kafka" and stream["startingOffsets"] == "latest"
    batch = kafka_batch(Recorder(), options)
    assert batch["startingOffsets"] == "earliest" and batch["endingOffsets"] == "latest"
    assert "maxOffsetsPerTrigger" not in batch


def test_session(spark):
    assert kafka_session("job")._options["spark.jars.packages"] == KAFKA_PACKAGE
    base = spark.conf.get("spark.checkpoint.dir")
    assert work_folder(spark, "x").startswith(f"{base}/msgflow/x-")
    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_send():
    class Sink(Recorder):
        def __init__(self):
            super().__init__()
            self.write = self

        def option(self, name, value):
            return self.options(**{name: value})

        def save(self):
            pass

    sink = Sink()
    send(sink, kafka_options(SECURE, "read-topic"), "t")
    assert sink.seen["format"] == "kafka" and sink.seen["topic"] == "t"
    assert "kafka.sasl.jaas.config" in sink.seen and "subscribe" not in sink.seen


def test_reported_offsets(spark):
    rows = end_offsets(spark, '{"a":{"0":5,"10":7},"b":{"0":0}}')
    assert rows.dtypes == [("topic", "string"), ("partition", "int"), ("end_offset", "bigint")]
    assert sorted(map(tuple, rows.collect())) == [("a", 0, 5), ("a", 10, 7), ("b", 0, 0)]


@pytest.mark.parametrize(
    "word, start",
    [("smallest", "earliest"), ("beginning", "earliest"), ("Earliest", "earliest"), ("largest", "latest"), ("end", "latest")],
)
def test_all_words_for_the_start(word, start):
    assert kafka_options({**PLAIN, "auto.offset.reset": word}, "t")["startingOffsets"] == start


def test_a_start_that_the_source_does_not_know():
    with pytest.raises(ValueError, match="auto.offset.reset"):
        kafka_options({**PLAIN, "auto.offset.reset": "error"}, "t")
