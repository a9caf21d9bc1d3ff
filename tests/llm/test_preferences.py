from lumbre.llm.preferences import answer_pairs, conversations, format_preferences

TURNS = "conv_id long, turn long, role string, text string, prompt string"


def apply_mask(text, mask):
    out, at = [], 0
    for run in mask.split(",") if mask else []:
        kind, n = run.split("x")
        out += [text[at : at + int(n)]] if kind == "1" else []
        at += int(n)
    assert at == len(text)
    return out


def test_common_prefix_and_masks(spark):
    turn = lambda r, t: {"role": r, "text": t}
    u, a, b = turn("user", "olá"), turn("assistant", "sim"), turn("assistant", "não")
    pairs = spark.createDataFrame(
        [(1, [u, a, u, a], [u, a, u, b]), (2, [u, a], [u, a]), (3, [u], [a]), (4, [u, a], [u]), (5, None, [u]), (6, [], [])],
        "pair_id int, chosen array<struct<role string, text string>>, rejected array<struct<role string, text string>>",
    )
    got = {r["pair_id"]: r for r in format_preferences(pairs).collect()}
    assert [got[i]["common_turns"] for i in range(1, 7)] == [3, 2, 0, 1, 0, 0]
    one = got[1]
    assert one["prompt"] == "<|user|>\nolá<|end|>\n<|assistant|>\nsim<|end|>\n<|user|>\nolá<|end|>\n"
    assert apply_mask(one["chosen"], one["chosen_mask"]) == ["sim<|end|>\n"] and apply_mask(one["rejected"], one["rejected_mask"]) == ["não<|end|>\n"]
    assert got[2]["chosen"] == got[2]["rejected"] == got[2]["chosen_mask"] == ""
    assert apply_mask(got[3]["chosen"], got[3]["chosen_mask"]) == [] and got[3]["prompt"] == ""
    assert got[4]["rejected"] == "" and apply_mask(got[4]["chosen"], got[4]["chosen_mask"]) == ["sim<|end|>\n"]


def test_pairs_by_brute_force(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    by = {}
    for r in sorted(turns.collect(), key=lambda r: (r["conv_id"], r["turn"])):
        by.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    got = {r["conv_id"]: r for r in format_preferences(answer_pairs(turns), "conv_id").collect()}
    assert set(got) == set(by)
    for key, own in by.items():
        answers = [i for i, t in enumerate(own) if t[0] == "assistant"]
        other = [t for t in by.get(key ^ 1, []) if t[0] == "assistant"]
        bad = list(own)
        if answers and other:
            bad[answers[-1]] = ("assistant", other[-1][1])
        elif answers:
            del bad[answers[-1]]
        n = next((i for i, (x, y) in enumerate(zip(own, bad)) if x != y), min(len(own), len(bad)))
        shown = lambda ts: "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in ts)
        assert (got[key]["common_turns"], got[key]["prompt"], got[key]["chosen"], got[key]["rejected"]) == (n, shown(own[:n]), shown(own[n:]), shown(bad[n:]))
        assert apply_mask(got[key]["chosen"], got[key]["chosen_mask"]) == [t + "<|end|>\n" for r, t in own[n:] if r == "assistant"]


def test_messy(spark):
    rows = [(0, 0, "user", None, "x"), (0, 1, None, "who", "x"), (0, 1, None, "who", "x"), (1, None, "assistant", "", "x"), (None, 0, "user", "q", "x"), (None, 1, "assistant", "a" * 100_000, "x")]
    turns = spark.createDataFrame(rows, TURNS)
    assert sorted((r["conv_id"] is None, r["conv_id"], len(r["turns"])) for r in conversations(turns).collect()) == [(False, 0, 3), (False, 1, 1), (True, None, 1), (True, None, 1)]
    got = format_preferences(answer_pairs(turns), "conv_id").collect()
    by = {r["conv_id"]: r for r in got}
    assert "<|unknown|>" in by[0]["prompt"] and len(got) == 4
    alone = sorted((len(r["prompt"]), len(r["chosen"]), r["rejected"]) for r in got if r["conv_id"] is None)
    assert [r[2] for r in alone] == ["", ""] and alone[0][1] > 100_000 and alone[1][1] == 0  # an answer without a partner, and a question
    assert format_preferences(answer_pairs(turns.limit(0)), "conv_id").count() == 0


def test_one_shuffle(spark, sf_dir):
    plan = format_preferences(answer_pairs(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "conv_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
