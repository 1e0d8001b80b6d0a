import re
from collections import Counter

import numpy as np
import pytest

from stratiform.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def model():
    random = np.random.default_rng(1)
    emit = {name: np.log(random.dirichlet(np.ones(size), 3).T) for name, size in chat.FEATURES.items()}
    return chat.Model(np.log(random.dirichlet(np.ones(3))), np.log(random.dirichlet(np.ones(3), (2, 3))), emit)


def every_path(start, scores, step, begins):
    paths = np.array(np.meshgrid(*[range(3)] * len(scores), indexing="ij")).reshape(len(scores), -1).T
    value = [start[p[0]] + scores[0][p[0]] + sum(step[begins[i + 1], a, b] + scores[i + 1][b] for i, (a, b) in enumerate(zip(p, p[1:]))) for p in paths]
    return max(value)


def test_viterbi_is_the_best_path():
    m, random = model(), np.random.default_rng(2)
    for n in (1, 2, 5):
        scores = np.log(random.random((n, 3)))
        begins = random.integers(0, 2, n)
        roles, _ = chat.viterbi(m.start, scores, m.step, begins)
        own = m.start[roles[0]] + scores[0][roles[0]] + sum(m.step[begins[i + 1], a, b] + scores[i + 1][b] for i, (a, b) in enumerate(zip(roles, roles[1:])))
        assert own == pytest.approx(every_path(m.start, scores, m.step, begins))


LINES = (
    [(1, i, None, "Human: how are you?" if i % 2 == 0 else "I am fine") for i in range(23)]
    + [(2, None, None, None), (2, 0, None, ""), (2, 0, None, "hello"), (2, 0, None, "hello")]
    + [(None, 0, None, "System: be kind"), (None, 1, None, "ok" * 40_000)]
)


@pytest.mark.parametrize("block", [1, 2, 5, 4096])
def test_blocks_give_one_pass_of_viterbi(spark, block):
    m = model()
    more = [(c, t, None, f"Bot: line {t}\nsecond" if t % 3 else "x") for c in range(100, 130) for t in range(6)]
    frame = spark.createDataFrame(LINES + more, SCHEMA).repartition(3)
    got = chat.recover_roles(frame, m, block=block).collect()
    split = lambda t: re.split("\r\n|\n|\r", t or "")
    assert Counter((r["conv_id"], r["turn"], r["text"], r["line"]) for r in got) == Counter(
        (c, t, text, i) for c, t, _, text in LINES + more for i in range(len(split(text)))
    )
    features = {}
    for r in chat.with_features(chat.split_lines(frame.select("text").distinct().withColumn("whole", chat.F.col("text")))).collect():
        features[r["whole"], r["line"]] = [r[c] for c in chat.CODES]
    for conversation in {r["conv_id"] for r in got}:
        mine = sorted((r for r in got if r["conv_id"] == conversation), key=lambda r: r["position"])
        assert [r["position"] for r in mine] == list(range(len(mine)))
        assert [r["turn"] is not None for r in mine] == sorted(r["turn"] is not None for r in mine)
        assert [r["turn"] or 0 for r in mine] == sorted(r["turn"] or 0 for r in mine)
        assert all(b["line"] == 0 or (b["line"] == a["line"] + 1 and a["text"] == b["text"]) for a, b in zip(mine, mine[1:]))
        codes = np.array([features[r["text"], r["line"]] for r in mine]).T
        roles, _ = chat.viterbi(m.start, m.scores(codes), m.step, codes[-1])
        assert [r["recovered_role"] for r in mine] == [chat.ROLES[k] for k in roles]
        assert [r["turn_no"] for r in mine] == np.cumsum(np.concatenate([[0], roles[1:] != roles[:-1]])).tolist()
        for r, code, role, before in zip(mine, codes[0], roles, [-1, *roles[:-1]], strict=True):
            line = split(r["text"])[r["line"]]
            assert r["rendered"].startswith(f"<|{chat.ROLES[role]}|>\n") == (role != before)
            if code != role + 1:
                assert r["rendered"].endswith(line + "\n")


def test_raw_transcripts_parse_into_turns(spark):
    marked = [(c, t, ("user", "assistant")[t % 2], ("what is it?\nplease tell", "it is this\n- and\n- that")[t % 2]) for c in range(30) for t in range(6)]
    m = chat.train(spark.createDataFrame(marked, SCHEMA))
    raw = "User: hi?\nAssistant: hello\nmore of it\r\nUser: how are you?\nAnswer: 42"
    rows = sorted(chat.recover_roles(spark.createDataFrame([(1, 0, None, raw)], SCHEMA), m).collect(), key=lambda r: r["position"])
    assert [r["recovered_role"] for r in rows] == ["user", "assistant", "assistant", "user", "assistant"]
    assert [r["turn_no"] for r in rows] == [0, 1, 1, 2, 3]
    assert "".join(r["rendered"] for r in rows) == "<|user|>\nhi?\n<|assistant|>\nhello\nmore of it\n<|user|>\nhow are you?\n<|assistant|>\n42\n"


def test_held_out_roles_are_recovered(spark):
    rows = chat.op1_hmm_chat(spark, "/root/testdata/sf0.01").where("held_out AND role IN ('system', 'user', 'assistant')")
    right, all_ = rows.selectExpr("sum(cast(role = recovered_role AS int))", "count(*)").first()
    assert all_ > 300 and right >= 0.99 * all_


def test_lines_inside_a_row_keep_their_role(spark):
    rows = [(c, t, ("system", "user", "assistant")[t % 3], "one\ntwo\nthree") for c in range(50) for t in range(6)]
    step = np.exp(chat.train(spark.createDataFrame(rows, SCHEMA)).step)
    assert (np.diag(step[0]) > 0.99).all() and (np.diag(step[1]) < 0.1).all()


def test_markers_of_another_role_stay(spark):
    m = model()
    m.emit["marker"][:] = 0
    for state in range(3):
        m.start[:] = m.step[:] = np.log(0.01)
        m.start[state] = m.step[:, :, state] = np.log(0.98)
        for text, own in (("System: a", 0), ("User: a", 1), ("Answer: a", 2)):
            (row,) = chat.recover_roles(spark.createDataFrame([(1, 0, None, text)], SCHEMA), m).collect()
            assert row["rendered"] == f"<|{row['recovered_role']}|>\n{'a' if row['recovered_role'] == chat.ROLES[own] else text}\n"


def test_repeated_rows_in_training_are_not_multiplied(spark):
    once = [(c, t, ("user", "assistant")[t % 2], "a line") for c in range(20) for t in range(4)]
    many = once + [(1, 1, "assistant", "a line")] * 10_000 + [(1, 2, "user", "a line")] * 10_000
    plain, repeated = (chat.train(spark.createDataFrame(rows, SCHEMA)) for rows in (once, many))
    # 20 steps of each kind, and 10 000 more from each repeated row to the next.
    assert np.exp(repeated.step[1, 1, 2]) == pytest.approx(40.5 / (40 + 10_000 + 1.5))
    assert np.exp(plain.step[1, 1, 2]) == pytest.approx(40.5 / 41.5)


def test_markers(spark):
    texts = {"User: hi": 2, "<|assistant|> hi": 3, "[system] hi": 1, "**Human**: hi": 2, "usernames: none": 0, "a thing": 0, "": 0}
    frame = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("m", chat.marker_of(chat.F.col("text")))
    assert {r["text"]: r["m"] for r in frame.collect()} == texts
    assert frame.select(chat.without_marker(chat.F.col("text"))).where("text like '%hi'").distinct().collect()[0][0] == "hi"


def test_training_recovers_marked_roles(spark):
    lines = [(c, t, ("user", "assistant")[t % 2], ("User: q?", "Bot: a")[t % 2]) for c in range(6) for t in range(4)]
    frame = spark.createDataFrame(lines + [(9, 0, None, "x"), (9, 1, "moderator", None)], SCHEMA)
    found = chat.recover_roles(frame.where("conv_id < 6"), chat.train(frame))
    assert found.count() == 24
    assert all(r["role"] == r["recovered_role"] for r in found.collect())


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert chat.recover_roles(frame, chat.train(frame)).count() == 0
