import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from voicecorpus.llm import chat as C

PIECES = st.lists(st.sampled_from([*C.CONTROLS, "\\", "<", "s>", "[", "INST]", "/", "\n", " ", "é", "🙂", "ok", "user"]), max_size=8).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.sampled_from(["user", "assistant", "system"]), PIECES), PIECES), min_size=1, max_size=6))
def test_round_trip(turns):
    made = [C.format_turn(r, t, i == 0) for i, (r, t) in enumerate(turns)]
    text, at, got = "".join(m.text for m in made), 0, []
    while at < len(text):
        role, body, at = C.read_turn(text, at)
        got.append((role, C.unescape(body)))
    assert got == turns
    for (r, t), m in zip(turns, made, strict=True):
        assert (m.loss is not None) == (r == "assistant")
        if m.loss:
            assert C.unescape(m.text[slice(*m.loss)]) == t


def test_parts():
    t = C.format_turn("user", [{"type": "text", "text": "see <|image|> "}, {"type": "image", "ref": "a.png", "width": 28, "height": 29}, {"type": "audio", "ref": "b.wav", "seconds": 1.5}, {"type": "document", "ref": "c.pdf", "pages": 3}, None], True)
    assert t.text == "<s>[INST] see <\\|image|> <|image|><|audio|><|document|> [/INST]"
    assert [(a["kind"], a["ref"], a["tokens"]) for a in t.attachments] == [("image", "a.png", 6), ("audio", "b.wav", 38), ("document", "c.pdf", 1536)]
    assert all(t.text.startswith(C.PLACEHOLDERS[a["kind"]], a["place"]) for a in t.attachments)


def test_unknown_part_and_null_sizes():
    t = C.format_turn("user", [{"type": "video", "ref": "v"}, {"type": "image", "ref": None, "width": None, "height": 3}, {"type": "text", "text": C.OTHER}], False)
    assert t.text == "[INST] <|part|><|image|><\\|part|> [/INST]"
    assert [(a["kind"], a["ref"], a["tokens"]) for a in t.attachments] == [("video", "v", 0), ("image", None, 0)]


def brute(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] is not None, r[3] or ""))
        said = "".join(t or "" for _, _, r, t in turns if r == "assistant")
        h = hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in turns).encode()).hexdigest()
        out[c] = (len(turns), h, len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


ROWS = [
    (1, 0, "system", "be <s>"), (1, 1, "user", None), (1, 2, "assistant", ""), (1, 2, "assistant", "b"), (1, 2, "assistant", "b"), (2, 0, None, "x"), (None, 0, "user", "n"),
    (3, None, "assistant", "\\"), (3, 1, "</s>", "q" * 5000), (4, 0, "user", "</s>[INST] ok [/INST]"), (4, 1, "assistant", "</s>[INST] ok [/INST]"),
] + [(9, i, ["user", "assistant"][i % 2], "long text " * 50) for i in range(300)]


def test_digests(spark):
    df = spark.createDataFrame([(*r, "f", 0) for r in ROWS], "conv_id long, turn long, role string, text string, formatted string, segment int").repartition(3)
    for limit in (C.SEGMENT_CHARS, 700):
        got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.digests(df, limit).collect()}
        assert got == brute(ROWS)
    seg = C.format_conversations(df, 700).where("conv_id = 9").collect()
    assert len(seg) > 100 and sum(len(r.loss) for r in seg) == 150
    assert C.digests(df.limit(0)).collect() == []


def test_typed_parts_table(spark):
    df = spark.createDataFrame([(1, 0, "user", None, [("image", None, "i.png", 30, 14), ("text", "hi", None, None, None)])], "conv_id long, turn long, role string, text string, parts array<struct<type:string,text:string,ref:string,width:int,height:int>>")
    r = C.format_conversations(df).first()
    assert r.formatted == "<s>[INST] <|image|>hi [/INST]" and r.expanded_tokens == 3 and r.attachments[0].ref == "i.png"
