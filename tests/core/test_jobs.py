import json

import pytest

from lectern import jobs
from lectern.operators import ledger
from lectern.sources import readers, settings


def speech():
    def model(row):
        if row["video_id"] == "bad":
            raise RuntimeError("cannot decode")
        words = [{"start": float(i), "end": i + 0.8, "word": f" w{i}", "probability": 0.9} for i in range(6)]
        segments = [{"id": 0, "start": 0.0, "end": 5.8, "text": " w0 w1 w2 w3 w4 w5 ", "words": words}, {"id": 1, "start": 6.0, "end": 7.0, "text": " tail ", "words": []}]
        return {"language": "en", "language_probability": 1.0, "duration": 10.0, "segments": segments}

    return model


def speakers():
    def model(row):
        if row["video_id"] == "mute":
            return {"turns": []}
        return {"turns": [{"speaker": "A", "start": 0.0, "end": 3.5}, {"speaker": "B", "start": 3.5, "end": 4.5}, {"speaker": "A", "start": 4.5, "end": 10.0}]}

    return model


@pytest.fixture(scope="module")
def project(tmp_path_factory):
    root = tmp_path_factory.mktemp("project")
    (root / "configs").mkdir()
    for name in ("acquisition", "audio", "transcription", "diarization"):
        (root / "configs" / f"{name}.yaml").write_text("{}")
    audio = root / "data/raw/audio"
    audio.mkdir(parents=True)
    for name in ("a.wav", "a.mp3", "b c.wav", "bad.wav", "mute.wav"):
        (audio / name).write_bytes(b"x")
    return root


def load(root, program):
    return settings.load(program, root / "configs" / f"{program}.yaml")


def row(df):
    return df.first().asDict()


def test_transcribe_then_diarize_then_evaluate(spark, project):
    config = load(project, "transcription")
    assert row(jobs.transcribe(spark, config, speech, dry_run=True)) == {"skipped": 0, "missing": 0, "would_transcribe": 5, "total": 5}
    assert row(jobs.transcribe(spark, config, speech)) == {"skipped": 1, "missing": 0, "succeeded": 3, "failed": 1, "total": 5}
    assert row(jobs.transcribe(spark, config, speech)) == {"skipped": 4, "missing": 0, "succeeded": 0, "failed": 1, "total": 5}
    folder = config.output.transcripts_dir
    docs = {r.video_id: r for r in readers.transcripts(spark, folder).collect()}
    assert set(docs) == {"a", "b c", "mute"}
    assert docs["a"].text == "w0 w1 w2 w3 w4 w5 tail" and docs["a"].segments[1].words is None and docs["a"].segments[0].words[0].word == " w0"
    assert docs["a"].model.size == "large-v3" and docs["a"].source_audio.endswith("a.mp3")
    book = readers.read_ledger(spark, config.output.history_file, ledger.TRANSCRIPTION).collect()
    assert sorted((r.video_id, r.status) for r in book) == [("a", "success"), ("b c", "success"), ("bad", "failed"), ("bad", "failed"), ("mute", "success")]
    assert {r.error for r in book if r.status == "failed"} == {"cannot decode"}

    config = load(project, "diarization")
    assert row(jobs.diarize(spark, config, speakers, dry_run=True)) == {"skipped": 0, "missing": 1, "would_diarize": 4, "total": 5}
    assert row(jobs.diarize(spark, config, speakers)) == {"skipped": 1, "missing": 1, "succeeded": 2, "failed": 1, "total": 5}
    assert row(jobs.diarize(spark, config, speakers)) == {"skipped": 3, "missing": 1, "succeeded": 0, "failed": 1, "total": 5}
    docs = {r.video_id: r for r in readers.diarized(spark, config.output.diarized_dir).collect()}
    assert set(docs) == {"a", "b c"} and docs["a"].target_speaker == "A" and docs["a"].target_speaker_text == "w0 w1 w2 w3 w5tail"

    found = jobs.evaluate_transcripts(spark, folder, str(project / "report"))
    assert row(found["counts"]) == {"num_files": 3, "num_flagged": 3} and found["worst"].count() == 3
    assert {r.flag for r in found["flag_counts"].collect()} == {"implausibly_slow"}
    assert spark.read.json(str(project / "report/summary")).first().num_files == 3
    assert [r.video_id for r in spark.read.json(str(project / "report/files")).collect()] == ["a", "b c", "mute"]
    found = jobs.evaluate_diarization(spark, config.output.diarized_dir, folder)
    assert row(found["counts"])["num_files"] == 2 and found["stats"].count() == 10
    assert found["worst"].first().line.startswith("a | speakers=2 share=0.90")

    references = project / "references"
    references.mkdir()
    for name, text in (("a", "w0 w1 w2 w3 w4 x5 tail"), ("b c", " \n"), ("gone", "x")):
        (references / f"{name}.txt").write_text(text)
    found = jobs.score_transcripts(spark, str(references), folder)
    assert row(found["counts"]) == {"num_scored": 1, "missing_transcript": 1, "empty_reference": 1}
    assert found["files"].first().wer == pytest.approx(1 / 7)
    assert row(jobs.export_texts(spark, folder, str(project / "texts"))) == {"exported": 3, "skipped": 0}
    assert row(jobs.export_texts(spark, folder, str(project / "texts"))) == {"exported": 0, "skipped": 3}
    jobs.export_target_texts(spark, config.output.diarized_dir, str(project / "target"), spark.createDataFrame([("a", "A title")], "video_id string, title string"))
    text = "".join(p.read_text() for p in sorted((project / "target").glob("part-*")))
    assert text.startswith("Topic: A title\nText: w0") and text.count("-" * 80) == 2


def test_the_next_file_of_a_stem_is_tried(spark, tmp_path):
    """x.mp3 fails, x.wav succeeds; all of y fail; z's first succeeds. Counts are those of a loop over the files."""
    (tmp_path / "configs").mkdir()
    (tmp_path / "configs/transcription.yaml").write_text("{}")
    audio = tmp_path / "data/raw/audio"
    audio.mkdir(parents=True)
    for name in ("x.mp3", "x.wav", "y.flac", "y.mp3", "y.wav", "z.mp3", "z.wav"):
        (audio / name).write_bytes(b"x")

    def load_model():
        def model(row):
            if not row["source_path"].endswith(("x.wav", "z.mp3")):
                raise RuntimeError(row["source_path"][-6:])
            return {"language": "en", "duration": 1.0, "segments": []}

        return model

    config = load(tmp_path, "transcription")
    assert row(jobs.transcribe(spark, config, load_model, dry_run=True)) == {"skipped": 0, "missing": 0, "would_transcribe": 7, "total": 7}
    assert row(jobs.transcribe(spark, config, load_model)) == {"skipped": 1, "missing": 0, "succeeded": 2, "failed": 4, "total": 7}
    book = readers.read_ledger(spark, config.output.history_file, ledger.TRANSCRIPTION).collect()
    assert sorted((r.video_id, r.status, r.source_path.rsplit("/", 1)[1]) for r in book) == [("x", "failed", "x.mp3"), ("x", "success", "x.wav"), ("y", "failed", "y.flac"), ("y", "failed", "y.mp3"), ("y", "failed", "y.wav"), ("z", "success", "z.mp3")]
    assert {r.video_id: r.source_audio.rsplit("/", 1)[1] for r in readers.transcripts(spark, config.output.transcripts_dir).collect()} == {"x": "x.wav", "z": "z.mp3"}
    assert row(jobs.transcribe(spark, config, load_model)) == {"skipped": 4, "missing": 0, "succeeded": 0, "failed": 3, "total": 7}


def test_rounds_of_nothing(spark, tmp_path):
    none = ledger.rounds(spark.createDataFrame([], "stem string, path string"), lambda t: t, str(tmp_path / "w"))
    assert none.count() == 0 and none.columns == ["stem", "path", "status", "error"]
    odd = spark.createDataFrame([(None, "a"), (None, "b"), ("s", "c")], "stem string, path string")
    found = ledger.rounds(odd, lambda t: t.selectExpr("*", "case when path = 'a' then 'no' end as error"), str(tmp_path / "v"))
    assert sorted((r.path, r.status) for r in found.collect()) == [("a", "failed"), ("b", "succeeded"), ("c", "succeeded")]


def test_extract_audio(spark, tmp_path):
    (tmp_path / "configs").mkdir()
    (tmp_path / "configs/audio.yaml").write_text('{"extract": {"format": "flac"}}')
    videos = tmp_path / "data/raw/videos"
    videos.mkdir(parents=True)
    for name in ("x.mp4", "y.mkv"):
        (videos / name).write_bytes(b"v")

    def encoder():
        from pathlib import Path

        def run(row):
            Path(row["output_path"]).parent.mkdir(parents=True, exist_ok=True)
            Path(row["output_path"]).write_text(f"{row['codec']} {row['sample_rate']} {row['channels']}")
            return {"ok": True}

        return run

    config = load(tmp_path, "audio")
    assert row(jobs.extract_audio(spark, config, encoder))["succeeded"] == 2
    assert (tmp_path / "data/raw/audio/x.flac").read_text() == "flac 16000 1"
    assert row(jobs.extract_audio(spark, config, encoder))["skipped"] == 2
    config.extract.format = "ogg"
    with pytest.raises(ValueError, match="unsupported audio format"):
        jobs.extract_audio(spark, config, encoder)


def test_download_waits_between_tries(spark, tmp_path):
    (tmp_path / "configs").mkdir()
    (tmp_path / "configs/acquisition.yaml").write_text('{"playlist": {"max_items": 4}, "download": {"quality": 720}}')
    config, log = load(tmp_path, "acquisition"), tmp_path / "waits"
    listing = spark.createDataFrame([(0, None, "no id", None, None), (1, "a", "", "http://e/a", None), (2, "b", "B", None, None), (3, "a", "again", None, None), (4, "c", "beyond", None, None)], "position int, id string, title string, webpage_url string, url string")

    def fetcher():
        def run(row):
            assert row["selector"].startswith("bestvideo[height<=720]")
            if row["video_id"] == "b":
                raise RuntimeError("refused")
            return {"title": "T", "ext": "webm", "unknown": 1}

        return run

    def sleep(seconds):
        with open(log, "a") as f:
            f.write(f"{seconds} ")

    assert row(jobs.download(spark, config, listing, fetcher, dry_run=True))["would_download"] == 3
    assert row(jobs.download(spark, config, listing, fetcher, sleep=sleep)) == {"skipped": 1, "missing": 0, "succeeded": 1, "failed": 1, "total": 3}
    assert log.read_text().split() == ["5.0", "10.0"]
    book = {r.video_id: r for r in readers.read_ledger(spark, config.output.history_file).collect()}
    assert book["a"].title == "a" and book["a"].url == "http://e/a" and book["a"].output_path.endswith("videos/a.webm")
    assert book["b"].error == "refused" and book["b"].url.endswith("watch?v=b")
    assert row(jobs.download(spark, config, listing, fetcher, sleep=lambda s: None))["skipped"] == 2
    assert [r.title for r in spark.read.json(config.output.metadata_dir).collect()] == ["T"]


def test_fetched_captions(spark, tmp_path):
    def fetcher():
        def run(row):
            if row["video_id"] == "c":
                raise RuntimeError("x")
            return {"text": None if row["video_id"] == "b" else "WEBVTT\n\n00:01 --> 00:02\nHost: Hi (laughs) there"}

        return run

    items = spark.createDataFrame([("a",), ("b",), ("c",)], "video_id string")
    folder = str(tmp_path / "captions")
    assert row(jobs.fetch_references(items, folder, fetcher, str(tmp_path / "w1"))) == {"existing": 0, "fetched": 1, "none": 1, "failed": 1, "total": 3}
    assert [(r.video_id, r.text) for r in readers.references(spark, folder).collect()] == [("a", "Hi there")]
    assert row(jobs.fetch_references(items, folder, fetcher, str(tmp_path / "w2"))) == {"existing": 1, "fetched": 0, "none": 1, "failed": 1, "total": 3}


def test_settings_of_all_programs(tmp_path):
    (tmp_path / "configs").mkdir()
    with pytest.raises(FileNotFoundError):
        settings.load("audio", tmp_path / "configs/none.yaml")
    given = {
        "acquisition": {"output": {"videos_dir": "v", "history_file": "/abs/h.csv"}, "download": {"quality": 720, "rate_limit": "5M"}, "retry": {"max_retries": "4", "retry_delay_seconds": 2}, "network": {"cookies_file": None}, "playlist": {"ignore_errors": True, "max_items": None}, "logging": None},
        "audio": {"input": {"videos_dir": "v"}, "extract": {"format": "mp3"}},
        "transcription": {"input": {"audio_dir": "s3://bucket/audio"}, "model": {"language": " AUTO ", "beam_size": 7, "vad_filter": False}},
        "diarization": {"target_speaker": {"strategy": "longest_total_duration"}, "model": {"device": "cpu"}, "unknown": {"x": 1}},
    }
    got = {}
    for name, values in given.items():
        (tmp_path / "configs" / f"{name}.yaml").write_text(json.dumps(values))
        got[name] = settings.load(name, tmp_path / "configs" / f"{name}.yaml")
    a = got["acquisition"]
    assert (a.output.videos_dir, a.output.history_file, a.output.audio_dir) == (str(tmp_path / "v"), "/abs/h.csv", str(tmp_path / "data/raw/audio"))
    assert (a.download.quality, a.download.rate_limit, a.retry.max_retries, a.retry.retry_delay_seconds, a.playlist.max_items, a.logging.level, a.network.cookies_file) == ("720", "5M", 4, 2.0, None, "INFO", None)
    assert (got["audio"].extract.format, got["audio"].extract.sample_rate, got["audio"].input.videos_dir) == ("mp3", 16000, str(tmp_path / "v"))
    assert (got["transcription"].model.language, got["transcription"].model.beam_size, got["transcription"].model.vad_filter, got["transcription"].input.audio_dir) == (None, 7, False, "s3://bucket/audio")
    assert (got["diarization"].model.device, got["diarization"].input.transcripts_dir) == ("cpu", str(tmp_path / "data/transcripts"))
    with pytest.raises(KeyError):
        settings.load("serving", tmp_path / "configs/audio.yaml")
