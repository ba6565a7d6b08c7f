from conceptmerge.llm import preferences as p

KIND = "id long, prompt_id string, chosen_turns array<struct<role:string,text:string>>, rejected_turns array<struct<role:string,text:string>>"


def one(spark, chosen, rejected):
    return p.preference_examples(spark.createDataFrame([(1, "x", chosen, rejected)], KIND)).first()


def render(turns):
    return "".join(f"<|im_start|>{(r or '').replace('<|', '< |')}\n{(t or '').replace('<|', '< |')}<|im_end|>\n" for r, t in turns)


def trained(text, mask):
    at, out = 0, []
    for run in mask.split(",") if mask else []:
        n, on = map(int, run.split(":"))
        if on:
            out.append(text[at : at + n])
        at += n
    assert at == len(text)
    return out


def test_common_prefix_and_masks(spark):
    head = [("system", "Be brief."), ("user", "Hi é"), ("assistant", "Hello.")]
    a, b = [*head, ("user", "More"), ("assistant", "Yes."), ("assistant", "Sure.")], [*head, ("user", "More"), ("assistant", "No <|im_end|> way")]
    r = one(spark, a, b)
    assert (r["n_prompt_turns"], r["prompt"], r["chosen"], r["rejected"]) == (4, render(a[:4]), render(a[4:]), render(b[4:]))
    assert trained(r["chosen"], r["chosen_mask"]) == ["Yes.<|im_end|>\n", "Sure.<|im_end|>\n"]
    assert trained(r["rejected"], r["rejected_mask"]) == ["No < |im_end|> way<|im_end|>\n"]


def test_edges(spark):
    turns = [("user", "a"), ("assistant", None), (None, "c")]
    same = one(spark, turns, turns)
    assert (same["n_prompt_turns"], same["prompt"], same["chosen"], same["chosen_mask"]) == (3, render(turns), "", "")
    apart = one(spark, turns, [("user", "b")])
    assert (apart["n_prompt_turns"], apart["prompt"], apart["rejected"]) == (0, "", render([("user", "b")]))
    longer = one(spark, turns, turns[:1])
    assert (longer["n_prompt_turns"], longer["rejected"]) == (1, "")
    none = one(spark, None, turns)
    assert (none["n_prompt_turns"], none["chosen"], none["rejected"]) == (0, "", render(turns))
    assert p.preference_examples(spark.createDataFrame([], KIND)).count() == 0


def test_turn_lists(spark):
    rows = [(1, 2, "assistant", "b. c. d"), (1, 0, "user", "a"), (1, 2, "assistant", "b. c. d"), (None, 0, "user", "n"), (2, None, "user", None)]
    listed = p.turn_lists(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in listed.collect()}
    assert got == {1: [("user", "a"), ("assistant", "b. c. d"), ("assistant", "b. c. d")], None: [("user", "n")], 2: [("user", None)]}
    cut = {r["conv_id"]: r for r in p.preference_examples(p.with_curtailed_answer(listed)).collect()}
    assert cut[1]["n_prompt_turns"] == 2 and cut[1]["rejected"] == render([("assistant", "b")]) and cut[2]["chosen"] == ""
    plan = p.preference_examples(p.with_curtailed_answer(listed))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_clashing_column_names(spark):
    import pytest

    df = spark.createDataFrame([(1, "x", [("user", "a")], [("user", "b")])], KIND)
    got = p.preference_examples(df.selectExpr("*", "1 _a", "2 a_", "3 P_"))
    assert got.columns[:5] == ["id", "prompt_id", "_a", "a_", "P_"] and [got.first()[c] for c in ("_a", "a_", "P_")] == [1, 2, 3]
    with pytest.raises(ValueError, match="Prompt"):
        p.preference_examples(df.selectExpr("*", "1 Prompt"))
