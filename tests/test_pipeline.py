import json

from siltstone.config import Config, Quality
from siltstone.models.clients import Replay, Template, generate
from siltstone.models.images import annotate
from siltstone.models.prompts import Prompts
from siltstone.plans import pipeline
from siltstone.sources import files, sinks
from siltstone.streaming import incremental

TEXT = " ".join(f"The pump number {i} in hall {i % 7} was checked by the crew in the year {1950 + i}." for i in range(60))


def test_run(spark):
    docs = spark.createDataFrame([(1, "a.txt", TEXT), (2, "b.txt", None), (3, "c.txt", "")], "doc_id bigint, source string, content string")
    ok, failed = pipeline.run(docs, Template(), Config(quality=Quality(min_question_words=5, answer_support=0.1, relevance=0.01)))
    rows = ok.collect()
    assert rows and all(r.doc_id == 1 and r.answer in TEXT for r in rows) and failed.count() == 0
    assert pipeline.run(docs.limit(0))[0].count() == 0


def test_run_rejects(spark):
    """Doubtful pairs and replies that cannot be parsed end among the failed, with their reason."""
    first = ("The pump in the hall is red and old and loud.", "It is red and that is so.", "Mind this: the pump in the hall is very loud.")
    ok, failed = pipeline.run(spark.createDataFrame([(i, "a.txt", f"{x} {TEXT}") for i, x in enumerate(first)], "doc_id bigint, source string, content string"), Template(), Config(quality=Quality(min_question_words=5, answer_support=0.0, relevance=0.0)))
    assert {r.reason for r in failed.collect()} == {"low_scores", "no_verdict"} and ok.count() >= 1


def test_shared_folder(spark, monkeypatch):
    from siltstone import io

    class Elsewhere:
        conf = spark.conf

        class sparkContext:
            master = "spark://x:7077"

            @staticmethod
            def getConf():
                return {}

    class Conf(dict):
        def get(self, key, default=None):
            return default

    Elsewhere.sparkContext.getConf = staticmethod(lambda: Conf())
    Elsewhere.conf = Conf()
    try:
        io.shared_dir(Elsewhere)
        raise AssertionError
    except ValueError:
        pass
    Elsewhere.sparkContext.master = "local[4]"
    assert io.shared_dir(Elsewhere).startswith("file://")
    kept = io.cut(spark.range(3))
    assert kept.count() == 3 and io.clean_up(spark) and not io.clean_up(spark)


def test_self_instruct(spark):
    docs = spark.createDataFrame([(1, "Rome is old and large.")], "doc_id bigint, content string")
    p = Prompts()
    prompt = p.fill("self_instruct", examples="Q: x?\nA: y", count=2, text="Rome is old and large.")
    got = pipeline.self_instruct(docs, [("x?", "y")], Replay({prompt: "Q: What is old?\nA: Rome\nQ: no mark\nA: Rome\nQ: Other?\nA: Paris"}), 2)
    assert [(r.question, r.answer) for r in got.collect()] == [("What is old?", "Rome")]


def test_failing_model(spark):
    def broken(prompts):
        raise RuntimeError

    assert [r.reply for r in generate(spark.createDataFrame([(1, "p")], "k int, prompt string"), broken, ["k"]).collect()] == [""]


def test_prompts():
    p = Prompts({"a": "x {y}"})
    p.add("b", "{z}")
    assert p.fill("a", y=1) == "x 1" and p.variables("b") == ["z"]
    for name, values in (("c", {}), ("a", {})):
        try:
            p.fill(name, **values)
            raise AssertionError
        except KeyError:
            pass


def test_files_and_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("hello   world")
    (folder / "b.docx").write_bytes(b"broken")
    (folder / "c.xyz").write_text("no")
    got = {r.source.rpartition("/")[2]: (r.content, r.error is None) for r in files.read_documents(spark, str(folder)).collect()}
    assert got == {"a.txt": ("hello world", True), "b.docx": (None, False)}
    out = str(tmp_path / "out")
    incremental.ingest(spark, str(folder), out, str(tmp_path / "cp")).awaitTermination()
    (folder / "d.txt").write_text("later on")
    incremental.ingest(spark, str(folder), out, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.content for r in spark.read.parquet(f"{out}/documents").collect()) == ["hello world", "later on"]
    assert spark.read.parquet(f"{out}/state").count() == 3


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("ü", None), ("b", 1)], "a string, b int")
    sinks.write_jsonl(df, str(tmp_path / "j"))
    back = files.read_jsonl(spark, str(tmp_path / "j"), "a string, b int")
    assert sorted(map(tuple, back.collect()), key=str) == [("b", 1), ("ü", None)]
    assert sinks.write_array(df, str(tmp_path / "x.json")) == 2 and {r["a"] for r in json.loads((tmp_path / "x.json").read_text())} == {"ü", "b"}
    assert sinks.write_if_any(df.limit(0), str(tmp_path / "none")) is False and not (tmp_path / "none").exists()


def test_images(spark):
    import struct

    png = b"\x89PNG\r\n\x1a\n" + b"\0" * 8 + struct.pack(">II", 3, 4)
    got = annotate(spark.createDataFrame([(1, bytearray(png)), (2, None)], "image_id int, bytes binary")).orderBy("image_id").collect()
    assert got[0].annotation.caption == "a PNG image of 3 by 4 pixels" and got[1].annotation.caption == ""


def test_chunks_of_whole_texts(spark):
    text = "word " * 25_000 + "the very last words"
    got = pipeline.chunks_of(spark.createDataFrame([(1, text)], "doc_id bigint, content string")).collect()
    assert any("the very last words" in r.content for r in got)
