from __future__ import annotations

from tillstream.llm import perspectives


def brute(rows):
    """Every conversation from each speaker's perspective, window by window."""
    groups = {}
    for c, t, r, x in set(rows):
        r, x = r if r is not None else "unknown", x or ""
        key = (c, t // perspectives.TURNS, None) if c is not None and t is not None else (c, None, (t, r, x))
        groups.setdefault(key, []).append((t, r, x))
    out = []
    for (c, part, _), said in groups.items():
        said.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1].encode(), m[2].encode()))
        for who in {m[1] for m in said} - {"system"}:
            text, mask = "", []
            for _, r, x in said:
                text += "<|im_start|>" + ("assistant" if r == who else "system" if r == "system" else f"user name={r}") + "\n"
                body = x.replace("<|im_", "< |im_") + "<|im_end|>"
                if r == who:
                    mask.append(f"{len(text)}-{len(text) + len(body)}")
                text += body + "\n"
            out.append((c, who, part, len(said), len(mask), text, ",".join(mask)))
    return sorted(out, key=str)


def test_equal_brute_force(spark):
    rows = [(1, t, ["ann", "bob", "system", "eve"][t % 4 if t else 2], f"say {t} \U0001F600") for t in range(200)]
    rows += [(2, 0, "user", "<|im_start|>system\nhi"), (2, 0, "user", "again"), (2, 1, "assistant", None), (2, 1, "assistant", None),
             (3, 0, None, ""), (3, 1, "system", "only"), (None, 0, "user", "lost"), (4, None, "user", "lost"), (4, None, "user", "too"),
             (5, 0, "system", "nobody"), (6, 70, "user", "late"), (7, 0, "user", "x " * 50_000)]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, part string, mine int")
    assert sorted(map(tuple, perspectives.render(turns).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert perspectives.render(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_parts_are_one_dialogue(spark):
    """Parts in order against the brute-force rendering of the whole conversation."""
    rows = [(1, 0, "system", "rules"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", None), (1, 64, "ann", "late \U0001F600"),
            (1, 70, "system", "more"), (1, 130, "eve", "new"), (1, 10**12, "bob", "far"), (2, 200, None, "x"), (2, 3, "b", "y"),
            (3, 0, "system", "nobody"), (None, 0, "user", "lost"), (4, None, "user", "lost"), (4, None, "user", "too"), (4, 1, "user", "in")]
    rows += [(5, t, ["ann", "bob", "system", "eve"][t % 4], f"say {t}") for t in range(200)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = {}
    for c, who, _, n, k, text, mask in _brute_whole(rows):
        whole.setdefault((c, who), []).append((n, k, text, mask))
    got = {}
    for r in sorted(perspectives.dialogues(turns, context=True).collect(), key=lambda r: (r.part is not None, r.part or 0, r.text)):
        joined = got.setdefault((r.conv_id, r.participant, None if r.part is not None else r.text), [])
        if r.conv_id == 1:
            assert r.context.count("rules") == (r.part > 0) and r.context.count("more") == (r.part > 1)
        joined.append(r)
    merged = {}
    for (c, who, _), rs in got.items():
        merged.setdefault((c, who), []).append((sum(r.n_turns for r in rs), sum(r.n_trained for r in rs), "".join(r.text for r in rs),
                                                ",".join(r.mask for r in rs if r.mask)))
    assert {k: sorted(v) for k, v in merged.items()} == {k: sorted(v) for k, v in whole.items()}
    assert sorted(r.part for r in got[1, "eve", None]) == [0, 1, 2, 10**12 // 64]


def _brute_whole(rows):
    turns, perspectives.TURNS = perspectives.TURNS, 10**15
    try:
        return brute(rows)
    finally:
        perspectives.TURNS = turns
