"""D4 error text and the whole D3 contract against direct models, on random input."""

from hypothesis import example, given, settings
from hypothesis import strategies as st

from routecast import schema as S
from routecast.functions.contract import err_text


def model(message: str) -> str:
    kept = message.split("\x00", 1)[0]
    if kept == "":
        kept = S.MSG_DECODE_FAILED
    return kept


def cut_model(message: str, n: int) -> str:
    return model(message).encode("utf-8")[:n].decode("utf-8", errors="ignore")


messages = st.text(
    alphabet=st.characters(blacklist_categories=("Cs",)),  # no lone surrogates
    max_size=140,
)


@settings(max_examples=8, deadline=None)
@given(st.lists(messages, min_size=1, max_size=60))
@example(["a" * 94 + "é" + "b", "a" * 93 + "€x", "a" * 94 + "€", "a" * 92 + "😀", "a" * 94 + "😀", "\x00x", "", "x\x00" + "y" * 200])
def test_err_text_matches_model(spark, batch):
    df = spark.createDataFrame([(i, m) for i, m in enumerate(batch)], "i int, m string")
    cols = [err_text(df["m"]).alias("e"), err_text(df["m"], S.ERR_FIELD_BYTES).alias("c"), err_text(df["m"], 2).alias("d")]
    got = {r["i"]: r for r in df.select("i", *cols).collect()}
    for i, m in enumerate(batch):
        assert got[i]["e"] == model(m), m
        assert got[i]["c"] == cut_model(m, S.ERR_FIELD_BYTES), m
        assert got[i]["d"] == cut_model(m, 2), m


# -- the whole contract (D3) against a model ----------------------------------

answers = st.fixed_dictionaries(
    {
        "rc": st.sampled_from([0, 0, 0, 1, -1]),
        "kind": st.sampled_from(["OK", "ERR", "NEED_MORE", "SKIP", "WAT"]),
        "data": st.text(alphabet="abc", max_size=5),
        "err": st.sampled_from(["", "boom", "x\\x00y", "m" * 120]),
    }
)


def contract_model(a: dict) -> tuple[str, bytes, str]:
    if a["rc"] == 0 and a["kind"] == "OK":
        return "data", a["data"].encode(), ""
    return "error", b"", model(a["err"])


@settings(max_examples=6, deadline=None)
@given(st.lists(answers, min_size=1, max_size=40))
def test_contract_matches_model(spark, batch):
    import json

    from routecast.functions.decoders import DecoderRegistry
    from routecast.operators.routing import decode
    from test_contract import scripted

    reg = DecoderRegistry()
    reg.register_column("scripted", scripted, library="lib")
    rows = [("t", 0, i, 1, None, json.dumps(a).encode()) for i, a in enumerate(batch)]
    env = spark.createDataFrame(rows, S.ENVELOPE_SCHEMA)
    bindings = spark.createDataFrame([("t", "lib", "scripted")], S.BINDING_SCHEMA)
    got = {r["offset"]: (r["kind"], bytes(r["data"]), r["err"]) for r in decode(env, bindings, reg).collect()}
    for i, a in enumerate(batch):
        assert got[i] == contract_model(a), (a, got[i])
