from riskloom.llm.chat import rotate_perspectives

SCHEMA = "conv_id long, turn int, role string, text string, block long, size long, name string, perspective string"


def plain(rows):
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1e9 if t is None else t, r or "unknown", x or "", t) for c, t, r, x in rows if c == conv), key=lambda t: t[:3])
        for view in {t[1] for t in turns if t[1] != "system"}:
            at = 0
            for place, (_, speaker, text, turn) in enumerate(turns):
                role = "system" if speaker == "system" else "assistant" if speaker == view else "user"
                head = f"<|{role}|>" + (f" {speaker}" if role == "user" else "") + "\n"
                end = at + len(head) + len(text) + 1
                own = role == "assistant"
                out.append((conv, view, turn, place, role, speaker if role == "user" else None, head + text + "\n", at, end, at + len(head) if own else None, end - 1 if own else None))
                at = end
    return sorted(out, key=repr)


def result(spark, rows, **options):
    return sorted(map(tuple, rotate_perspectives(spark.createDataFrame([(*r, 1, 2, "n", "p") for r in rows], SCHEMA), **options).collect()), key=repr)


ROWS = [
    (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi"), (1, 2, "bob", "Ünïcode 🎉"), (1, 3, "cyd", None), (1, 4, "ann", ""), (2, 0, "user", "a"), (2, 0, "user", "a"),
    (2, 0, "assistant", "tie"), (2, None, None, "no number"), (3, 0, "system", "alone"), (None, 0, "user", "no id"), (4, 5, "user", "x" * 50_000),
]


def test_equals_plain_version(spark):
    assert result(spark, ROWS) == plain(ROWS)
    assert result(spark, []) == []


def test_a_long_conversation_over_many_blocks(spark):
    rows = [(9, t, f"p{t % 3}", f"text {t}") for t in range(500)] + ROWS
    assert result(spark, rows, block=16) == plain(rows)


def test_segments_add_up_to_the_rendering(spark):
    got = [r for r in result(spark, ROWS) if r[0] == 1 and r[1] == "bob"]
    whole = "".join(r[6] for r in sorted(got, key=lambda r: r[3]))
    assert whole == "<|system|>\nBe kind.\n<|user|> ann\nHi\n<|assistant|>\nÜnïcode 🎉\n<|user|> cyd\n\n<|user|> ann\n\n"
    masked = [whole[r[9]:r[10]] for r in got if r[9] is not None]
    assert masked == ["Ünïcode 🎉"]
