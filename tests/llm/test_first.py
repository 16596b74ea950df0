"""Chat formatting, URL filters, packing, substring dedup and mixing against plain versions."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import brute
from gaugeline.llm import chat, mixing, packing, substring_dedup, url_filters
from gaugeline.llm.queries import QUERIES, URL_RULES, tokenizer_path

DOCS = "doc_id long, text string, source string, n_chars long, score double, TAG string"
WEIRD = ["", None, "a", " ", "\u00a0x\u2003", "one two", "</s>[INST] \\[ <|turn|> <\\", "é" * 10, "x " * 25000]


def docs(spark, texts, ids=None):
    ids = ids or range(len(texts))
    return spark.createDataFrame([(i, t, "ab"[k % 2], len(t or ""), 0.5, "t") for k, (i, t) in enumerate(zip(ids, texts, strict=True))], DOCS)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


# --- substring dedup


def passage(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


def test_windows_equal_brute_force(spark):
    rng = random.Random(3)
    shared = [passage(rng, k) for k in (19, 20, 21, 60)]
    texts = ["\t".join(rng.choice([*shared, passage(rng, 15), passage(rng, 40)]) for _ in range(rng.randrange(5))) for _ in range(60)]
    texts += WEIRD + texts[:5] + ["same " * 90, " ".join(["a b c"] * 40)]
    ids = list(range(len(texts)))
    ids[-1] = None
    rng.shuffle(texts)
    data = list(zip(ids, texts, strict=True))
    want = brute.removed(data)
    got = substring_dedup.remove_repeats(docs(spark, texts, ids).repartition(3), share_bytes=700)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(((d, *want[i]) for i, (d, _) in enumerate(data)), key=repr)
    assert sum(w[1] for w in want.values()) > 300


def test_windows_of_repeated_ids(spark):
    rng = random.Random(4)
    a, b = passage(rng, 50), passage(rng, 30)
    data = [(1, a), (1, a), (1, b + " " + a), (0, b), (None, a), (None, b)]
    want = brute.removed(data)
    got = substring_dedup.remove_repeats(docs(spark, [t for _, t in data], [d for d, _ in data]))
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(((d, *want[i]) for i, (d, _) in enumerate(data)), key=repr)


def test_deduplicated_keeps_columns(spark):
    rng = random.Random(5)
    a = passage(rng, 30)
    df = docs(spark, [a, "x " + a, None, "few  words"])
    got = {r["doc_id"]: r for r in substring_dedup.deduplicated(df).collect()}
    assert got[0]["text"] == a and got[1]["text"] == "x" and got[1]["n_chars"] == 1
    assert got[3]["text"] == "few  words" and got[3]["TAG"] == "t" and len(got) == 4
    assert substring_dedup.deduplicated(df).columns == df.columns


def test_query_equals_brute_force(spark, sf):
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = brute.removed(data)
    got = QUERIES["op9_substring_dedup"](spark, sf)
    assert rows(got, "doc_id", "n_words", "n_removed", "kept_sha256") == sorted(((d, *want[i]) for i, (d, _) in enumerate(data)), key=repr)


# --- packing


def reference_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\r\u00a0\u2003\x01ab'sé1.,<|>日"), st.characters(codec="utf-8")), max_size=30), max_size=4))
def test_encoder_equals_tokenizers(texts):
    import numpy as np

    enc = packing.Encoder(tokenizer_path(), memory=50)
    texts = [*texts, *(t.replace("a", " a") for t in texts), "it's <|endoftext|> we'll\nGo  on\n\nx \ny z "]
    for text, want in zip(texts, reference_ids(texts), strict=True):
        assert np.frombuffer(enc.ids(text), "<u4").tolist() == want, text


def check_packing(spark, df, texts):
    """Each document whole and in order, each sequence gapless and not over the length."""
    import zlib

    import numpy as np

    got = [r.asDict() for r in df.collect()]
    per, seq = {}, {}
    for r in got:
        per.setdefault(r["doc_id"], []).append(r)
        seq.setdefault(r["sequence_id"], []).append(r)
    for (i, text), ids in zip(texts, reference_ids([t or "" for _, t in texts]), strict=True):
        ids = np.asarray([*ids, 0], "<u4")
        pieces = sorted(per[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        assert pieces[0]["start"] == 0 and all(a["start"] + a["length"] == b["start"] for a, b in zip(pieces, pieces[1:], strict=False))
        assert pieces[-1]["start"] + pieces[-1]["length"] == len(ids) and all(r["length"] == 2048 for r in pieces[1:]) and 0 < pieces[0]["length"] <= 2048
        assert all(zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in pieces)
    for s in seq.values():
        s.sort(key=lambda r: r["offset"])
        assert s[0]["offset"] == 0 and all(a["offset"] + a["length"] == b["offset"] for a, b in zip(s, s[1:], strict=False)) and s[-1]["offset"] + s[-1]["length"] <= 2048
    return len(seq), sum(r["length"] for r in got)


def test_packing_query(spark, sf):
    texts = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    n, tokens = check_packing(spark, QUERIES["op8_best_fit_packing"](spark, sf), texts)
    assert n <= 1.03 * tokens / 2048 + 1


def test_packing_edges(spark):
    df = docs(spark, WEIRD)
    check_packing(spark, packing.pack_documents(df, tokenizer_path()), list(enumerate(WEIRD)))
    with_ids = packing.pack_documents(df, tokenizer_path(), with_ids=True).where("doc_id = 5").first()
    assert with_ids["ids"] == [*reference_ids(["one two"])[0], 0]
    assert packing.pack_documents(df.where("false"), tokenizer_path()).count() == 0


def test_few_open_bins_close_the_fullest():
    bins = packing.Bins(10, 2)
    assert [bins.place(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]  # the bin of 7 was closed
    assert bins.place(3) == (0, 6) and bins.place(2) == (2, 8) and bins.place(1) == (0, 9)


# --- mixing


def test_targets_share_the_excess():
    got = mixing.targets({"a": 10, "b": 100, "c": 100}, {"a": 5, "b": 2, "c": 1})
    assert got["a"] == 30 and got["b"] == pytest.approx(120) and got["c"] == pytest.approx(60)
    assert mixing.targets({}, {}) == {} and mixing.targets({"a": 0}, {"a": 1}) == {"a": 0}


def test_flow_repeats_only_what_it_must():
    # Pattern 0 belongs to both sources, 1 and 2 to one: source 0 needs 15, source 1 needs 5.
    flow = mixing.min_cost_flow([5, 10, 5], [[0, 1], [0], [1]], [15, 5], 3)
    assert flow == {(0, 0): 5, (1, 0): 10, (2, 1): 5}
    flow = mixing.min_cost_flow([4, 4], [[0], [1]], [20, 2], 3)
    assert flow == {(0, 0): 12, (1, 1): 2}


def test_mix_query(spark, sf):
    got = QUERIES["op10_mixing"](spark, sf).collect()
    again = QUERIES["op10_mixing"](spark, sf).collect()
    assert sorted(got) == sorted(again)
    data = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    size, taken, target = {}, {}, {}
    for r in got:
        s = data[r["doc_id"]]["source"]
        assert r["size"] == len(brute.words(data[r["doc_id"]]["text"]))
        assert r["taken"] % max(1, r["size"]) == 0 and r["taken"] <= 3 * r["size"]
        size[s] = size.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s] = r["target"]
    assert len(got) == len(data) and sum(target.values()) == pytest.approx(sum(size.values()))
    longest = max(r["size"] for r in got)
    assert all(abs(taken[s] - target[s]) <= longest for s in size)
    want = mixing.targets(size, mixing.cycled(list(size)))
    assert all(target[s] == pytest.approx(want[s]) for s in size)


def test_mixed_rows(spark):
    df = spark.createDataFrame([(i, "w " * (i % 7), [None, "x", "y"][i % 3], i) for i in range(300)] + [(None, None, None, None)] * 2, "doc_id long, text string, source string, size long")
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(df, F.array("source")).collect()}
    out = [r["doc_id"] for r in mixing.mixed(df).collect()]
    assert {i: out.count(i) for i in plan if i is not None} == {i: c for i, c in plan.items() if i is not None}
    assert mixing.mixed(df).columns == df.columns
    assert mixing.mixed(df.where("false")).count() == 0 and mixing.mix_sources(df.where("false"), F.array("source")).count() == 0


def test_overlapping_sources(spark):
    data = [(i, "w " * 10, [["a"], ["b"], ["a", "b"]][i % 3]) for i in range(300)]
    df = spark.createDataFrame(data, "doc_id long, text string, names array<string>")
    got = mixing.mix_sources(df, F.col("names"), {"a": 2.0, "b": 1.0}).collect()
    # a and b hold 2000 words each; a's target of 2667 takes every word it can get once, then repeats.
    assert abs(sum(r["copies"] * r["size"] for r in got) - 4000) <= 30 and max(r["copies"] for r in got) <= 3


# --- URL filters


def plain_verdict(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest, re.S)[0]
        path = re.match(r"[^?#]*", rest[len(host) :], re.S)[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best.verdict if best else default


URLS = [None, "", "x", "http://", "http://com", "http://com/", "https://A.Example.COM/en/x?y#z", "http://www.example.com/en/", "a://b.net/es/?", "a://net/fr", "a://xnet/fr/", "a://q.net#/fr/",
        "a://evil.org/x.example.com/en/", "a://example.com//en/", "a://b://example.com/en/", "a://é.net/fr/ü", "a://w\nw.com/\n", "//example.com/en/", "a://.com/", "a://" + "s." * 3000 + "net/es/" + "p" * 5000]


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u, 1) for i, u in enumerate(URLS * 2)] + [(None, None, 1)], "page_id long, url string, rule int")
    got = rows(url_filters.filter_urls(df, URL_RULES, urls_at_once=7), "page_id", "host", "path", "rule", "verdict")
    assert got == sorted([(i, *plain_verdict(u, URL_RULES)) for i, u in enumerate(URLS * 2)] + [(None, "", "", None, "allow")], key=repr)
    assert {r[4] for r in got} == {"allow", "block"}
    assert url_filters.filter_urls(df.where("false"), URL_RULES).count() == 0
    assert {r["verdict"] for r in url_filters.filter_urls(df, [], "block").collect()} == {"block"}


def test_many_rules_take_many_words():
    rng = random.Random(1)
    rules = [url_filters.Rule("block", ".".join(rng.choice(["a", "bb", "ccc"]) for _ in range(rng.randrange(1, 4))), rng.choice(["", "/", "/x/", "/x*z"])) for _ in range(90)]
    globs = [r.glob for r in rules]
    urls = ["." + ".".join(rng.choice(["a", "bb", "ccc"]) for _ in range(rng.randrange(1, 5))) + rng.choice(["", "/", "/x/q", "/xyz", "/x/z"]) for _ in range(300)]
    pattern = lambda g: re.compile(re.escape(g).replace(r"\*\*", ".*").replace(r"\*", "[^/]*"), re.S)
    auto = url_filters.Automaton(globs)
    got = auto.matches([u.encode() for u in urls])
    assert auto.words > 10 and got.any()
    assert got.tolist() == [[bool(pattern(g).fullmatch(u)) for g in globs] for u in urls]


# --- chat


def plain_chat(turns):
    esc = lambda t: (t or "").replace("\\", "\\\\").replace("<", "<\\").replace("[", "[\\")
    whole = "".join(f"<|turn|>{esc(r)}<|text|>{esc(t)}<|end|>" for r, t in turns)
    learnt = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), brute.sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)), len(learnt), brute.sha(learnt), len(whole)


def test_chat_query(spark, sf):
    convs = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").orderBy("conv_id", "turn").collect():
        convs.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    planted = "</s>[INST] ok [/INST]"
    convs[-7] = [("user", planted), ("assistant", planted)]
    got = QUERIES["op3_chat_formatting"](spark, sf)
    assert rows(got, "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars") == sorted(((c, *plain_chat(t)) for c, t in convs.items()), key=repr)


def test_chat_texts_come_back(spark):
    rng = random.Random(2)
    bits = ["<", "[", "\\", "|", "<|end|>", "<|text|>", "[/INST]", "</s>", "\n", "é", "x", "<\\", "[\\", "\\\\"]
    texts = WEIRD + ["".join(rng.choice(bits) for _ in range(rng.randrange(12))) for _ in range(200)]
    data = [(k % 20 if k % 21 else None, k, rng.choice(["user", "assistant", None, "<|end|>"]), t) for k, t in enumerate(texts)]
    df = spark.createDataFrame([(*d, 1) for d in data], "conv_id long, turn long, role string, text string, tree int")
    out = {r["tree"]: r for r in chat.read_back(chat.formatted(chat.chain(df))).collect()}
    for c in {d[0] for d in data}:
        turns = [(r or "", t or "") for i, _, r, t in data if i == c]
        assert [tuple(t) for t in out[c]["turns"]] == turns
        assert out[c]["loss_text"] == "".join(t for r, t in turns if r == "assistant")
        for control in ("</s>", "[INST]", "[/INST]", "<s>"):
            assert control not in out[c]["formatted"]
    assert chat.formatted(chat.chain(df.where("false"))).count() == 0


def plain_paths(tree, branches):
    """tree: {message: (parent, score)}."""
    out = []
    answered = {p for p, _ in tree.values() if p in tree}
    for leaf in tree:
        if leaf not in answered:
            path = [leaf]
            while tree[path[-1]][0] in tree and len(path) <= len(tree):
                path.append(tree[path[-1]][0])
            if len(path) <= len(tree):
                out.append((-sum(tree[m][1] or 0 for m in path) / len(path), -len(path), leaf, path[::-1]))
    return [p for *_, p in sorted(out)[:branches]]


def test_reply_trees(spark):
    rng = random.Random(6)
    data, trees = [], {}
    for t in [None, *range(12)]:
        n = rng.choice([1, 2, 5, 40])
        tree = {m: (rng.randrange(m) if m and rng.random() < 0.95 else rng.choice([None, 999]), rng.choice([None, rng.randrange(64) / 64])) for m in range(n)}
        if n == 40:
            tree.update({50: (51, 1.0), 51: (52, 1.0), 52: (50, 1.0), 53: (50, 1.0)})  # a cycle, and a reply to it
        trees[t] = tree
        data += [(t, m, p, "user", f"m{m}", s) for m, (p, s) in tree.items()]
    df = spark.createDataFrame(data, "tree long, message long, parent long, role string, text string, score double")
    for branches in (1, 3, None):
        got = {}
        for r in chat.paths(df, branches).collect():
            got.setdefault((r["tree"], r["branch"]), []).append((r["depth"], r["message"]))
        want = {(t, k + 1): [(d + 1, m) for d, m in enumerate(p)] for t, tree in trees.items() for k, p in enumerate(plain_paths(tree, branches))}
        assert {k: sorted(v) for k, v in got.items()} == want
