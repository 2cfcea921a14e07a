"""Python decoders (U2): one Arrow UDF, masked inputs, errors as rows."""

from routecast import schema as S
from routecast.functions.decoders import DecodeOut, DecoderRegistry, PyEnvelope
from routecast.operators.routing import decode
from routecast.plans import samples
from routecast.sources.envelopes import read_events

SF = "/root/testdata/sf0.001"


def test_decoder_runs_only_on_bound_rows(spark):
    acc = spark.sparkContext.accumulator(0)

    def counting(env: PyEnvelope):
        acc.add(1)
        return DecodeOut(data=env.payload[::-1])

    reg = samples.build_sample_registry(with_python=False)
    reg.register_python("rev", counting, library="py")
    env = read_events(spark, SF)
    bindings = samples.bindings_df(spark, [("view", "py", "rev"), ("error", "samples", "skip_all")])
    events = decode(env, bindings, reg, topics=["click"])
    rows = events.collect()
    n_view = sum(1 for r in rows if r["topic"] == "view")
    assert acc.value == n_view
    for r in rows:
        if r["topic"] == "view":
            assert r["kind"] == "data" and r["decoder"] == "rev"
        if r["topic"] == "click":
            assert r["decoder"] == S.DEFAULT_SYMBOL and r["kind"] == "data"


def test_exception_becomes_error_row(spark):
    def boom(env: PyEnvelope):
        if b"1" in (env.payload or b""):
            raise RuntimeError("no ones " + "z" * 200)
        return (0, "OK", b"fine", "")

    reg = DecoderRegistry()
    reg.register_python("boom", boom, library="py")
    env = read_events(spark, SF)
    b = samples.bindings_df(spark, [(t, "py", "boom") for t in ["click", "view", "error", "purchase", "signup"]])
    rows = decode(env, b, reg).collect()
    assert len(rows) == env.count()
    for r in rows:
        payload = r["topic"]  # just to use the row
        if r["kind"] == "error":
            assert r["err"].startswith("RuntimeError: no ones")
            assert len(r["err"]) == len("RuntimeError: no ones ") + 200
        else:
            assert bytes(r["data"]) == b"fine" and r["err"] == ""
        assert payload


def test_odd_answers_become_error_rows(spark):
    answers = {
        b"none": DecodeOut(rc=None), b"big": DecodeOut(rc=2**40), b"text": DecodeOut(rc="0"), b"kind": (0, None, b"x"),
        b"lone": DecodeOut(kind="ERR", err="a\ud800b"), b"type": 7, b"many": (0, "OK", b"", "", 1, 2), b"str": DecodeOut(data="é\ud800"),
    }

    def odd(env: PyEnvelope):
        return answers[env.payload]

    reg = DecoderRegistry()
    reg.register_python("odd", odd, library="py")
    env = spark.createDataFrame([("t", 0, i, 1, None, k) for i, k in enumerate(answers)], S.ENVELOPE_SCHEMA)
    b = samples.bindings_df(spark, [("t", "py", "odd")])
    got = {list(answers)[r["offset"]]: r for r in decode(env, b, reg).collect()}
    assert {k: r["kind"] for k, r in got.items()} == {k: "data" if k == b"str" else "error" for k in answers}
    assert got[b"lone"]["err"] == "a?b" and bytes(got[b"str"]["data"]) == "é?".encode()
    assert got[b"big"]["err"].startswith("TypeError")


def test_batch_decoders(spark):
    import pyarrow as pa
    import pyarrow.compute as pc

    from routecast.functions.decoders import BatchOut

    def upper(batch):
        texts = pc.cast(pc.fill_null(batch.payload, b""), pa.large_string())
        return BatchOut(pc.utf8_upper(texts), pc.if_else(pc.equal(texts, "no"), "refused", None))

    reg = DecoderRegistry()
    reg.register_batch("upper", upper, library="py")
    reg.register_batch("short", lambda batch: BatchOut(pa.array([b"x"])), library="py")
    rows = [("t", 0, 0, 1, None, b"abc"), ("t", 0, 1, 1, None, b"no"), ("t", 0, 2, 1, None, None), ("s", 0, 3, 1, None, b"a"), ("s", 0, 4, 1, None, b"b")]
    env = spark.createDataFrame(rows, S.ENVELOPE_SCHEMA).coalesce(1)
    b = samples.bindings_df(spark, [("t", "py", "upper"), ("s", "py", "short")])
    got = {r["offset"]: (r["kind"], bytes(r["data"]), r["err"]) for r in decode(env, b, reg).collect()}
    assert got[0] == ("data", b"ABC", "") and got[1] == ("error", b"", "refused") and got[2] == ("data", b"", "")
    assert got[3][0] == got[4][0] == "error" and "1 answers for 2 messages" in got[3][2]


def test_a_filter_does_not_run_decoders_twice(spark):
    from routecast.operators.routing import split_events, to_drain
    from routecast.operators.stats import dispatch_counts
    from routecast.sources.envelopes import read_documents

    env = read_documents(spark, SF)
    b = samples.bindings_df(spark, samples.DOCUMENT_BINDINGS)
    events = decode(env, b, samples.sample_registry(with_python=True))
    for df in (*split_events(events), dispatch_counts(to_drain(events))):
        assert df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_mixed_column_and_python_decoders(spark):
    from routecast.sources.envelopes import read_documents

    env = read_documents(spark, SF)
    b = samples.bindings_df(spark, samples.DOCUMENT_BINDINGS)
    rows = decode(env, b, samples.sample_registry(with_python=True)).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(SF + "/documents.parquet").collect()}
    import hashlib
    import unicodedata

    for r in rows:
        text = texts[r["offset"]].encode()
        if r["topic"] == "es":
            assert bytes(r["data"]) == text
        elif r["topic"] == "fr":
            assert bytes(r["data"]).decode() == unicodedata.normalize("NFC", text.decode())
        elif r["topic"] == "de":
            assert bytes(r["data"]) == f"{hashlib.md5(text).hexdigest()[:16]} ".encode() + text
        elif b"!!" in text:
            assert r["kind"] == "error" and r["err"] == f"ValueError: payload shouts {text.count(b'!!')} times"
        else:
            assert bytes(r["data"]) == text.replace(b"\n", b" ")
