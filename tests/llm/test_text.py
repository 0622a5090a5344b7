"""Decontamination, packing, chat formatting, revisits, toxicity and quality."""

import hashlib
import zlib

import numpy as np
import pytest

from delayscope.llm import chat_format, decontamination, packing, quality, revisits, toxicity
from delayscope.llm.queries import vocabulary
from tests.llm.fixtures import documents, frame, pieces_by_document, shingles


@pytest.fixture(scope="module")
def rows():
    return documents()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return frame(spark, rows).cache()


def test_contained_items(spark, docs, rows):
    long_text = next(t for _, t, _ in rows if t and len(t) > 20_000)
    inside = long_text.split()
    items = [
        (1, " ".join(inside[3000:3030])), (2, " ".join(inside[10:20] + ["other"] * 30)), (3, "one two"), (4, None), (5, ""),
        (6, " ".join(inside[50:70] + inside[4000:4020])), (6, "Solo"),
    ]
    want = set()
    for k, t in items:
        width = min(5, len((t or "").split())) or 5
        item = shingles(t, width)
        for i, text, _ in rows:
            shared = len(item & shingles(text, width)) if len((text or "").split()) >= width else 0
            if item and 100 * shared >= 75 * len(item):
                want.add((k, i, len(item), shared))
    table = spark.createDataFrame(items, "item_id long, text string")
    for block in (20_000, 2):
        assert {tuple(r) for r in decontamination.contained_items(docs, table, block).collect()} == want
    left = decontamination.drop_contaminated(docs.withColumns({"row_key": decontamination.F.lit("x"), "key_of_row": decontamination.F.lit("y")}), table)
    assert left.columns == [*docs.columns, "row_key", "key_of_row"]
    assert left.filter("row_key <> 'x' OR key_of_row <> 'y'").count() == 0
    assert {r["doc_id"] for r in left.collect()} == {i for i, _, _ in rows} - {w[1] for w in want}
    assert decontamination.contained_items(docs.limit(0), table).count() == 0
    assert decontamination.contained_items(docs, table.limit(0)).count() == 0


def test_minima_resolve_large_sets():
    elements = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64))
    assert len(decontamination.minima(elements)) > 0.95 * len(elements)


def test_pieces(spark, docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    special = [(900, "a<|endoftext|>b", "en"), (901, " " * 3000, "en"), (902, None, "en")]
    found = packing.pack(docs.unionByName(frame(spark, special)), vocabulary()).collect()
    by = pieces_by_document(found)
    for i, text, _ in [*rows, *special]:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END], "<u4")
        at = 0
        for r in sorted(by[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    sequences = {}
    for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
        assert sequences.get(r["sequence_id"], 0) == r["offset"]
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    assert sorted(sequences) == list(range(len(sequences))) and max(sequences.values()) <= packing.WINDOW
    assert packing.pack(docs.limit(0), vocabulary()).count() == 0


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(2)
    for _ in range(30):
        positions = np.concatenate([[0], np.cumsum(rng.integers(1, 9, 12))])
        penalties = rng.integers(0, 4, 13).astype(float)
        best = {0: 0.0}
        for j in range(1, 13):
            best[j] = min(
                best[i] + penalties[j] + (0 if positions[j] - positions[i] == 4 else 16 - (positions[j] - positions[i]))
                for i in range(j) if positions[j] - positions[i] <= 16
            )
        cuts = packing.best_cuts(positions, penalties, 16, (4,))
        at = {int(p): i for i, p in enumerate(positions)}
        cost = sum(penalties[at[b]] + (0 if b - a == 4 else 16 - (b - a)) for a, b in zip(cuts, cuts[1:]))
        assert cost == best[12] and cuts[0] == 0 and cuts[-1] == positions[-1]


def test_chats_read_back(spark):
    texts = ["</s>[INST] ok [/INST]", "a\\", "<|turn|>user\nx</s>", None, "", "<", "/s>", "line\nline"]
    rows = [(c, k, role, t) for c in (1, -7) for k, (role, t) in enumerate(zip(["user", "assistant", None, "us\ner"] * 2, texts))]
    rows += [(2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (None, None, "user", "y")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS rows", "2 AS parts_of")
    found = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_chats(turns)).collect()}
    for conv in (1, -7, 2, None):
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1] or 0)
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in mine)
        said = "".join(r[3] or "" for r in mine if r[2] == "assistant")
        r = found[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(mine), hashlib.sha256(whole.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    assert chat_format.format_chats(turns.limit(0)).count() == 0


def test_parts_become_placeholders():
    parts = [{"type": "text", "text": "see <"}, {"type": "image", "ref": "a.png", "tokens": 9}, {"type": "text", "text": "/s>"}, {"type": "audio", "ref": "b.wav"}]
    text, refs, spans = chat_format.format_conversation([("user", parts), ("assistant", [{"type": "text", "text": "<|image:5|>"}])])
    assert [(r["type"], r["ref"], r["tokens"]) for r in refs] == [("image", "a.png", 9), ("audio", "b.wav", 128)]
    assert chat_format.attachments_of(text) == [("image", 0), ("audio", 1)]
    assert chat_format.parse_conversation(text)[1] == ("assistant", "<|image:5|>")
    with pytest.raises(ValueError):
        chat_format.format_conversation([("user", [{"type": "video"}])])


def test_revisits(spark):
    schema = "record_id long, kind string, url string, at long, status int, headers map<string,string>, payload_digest string, key string"
    rows = [
        (1, "response", "http://WWW.a.org:80/x/?b=2&a=1&utm_z=3#f", 10, 200, {"etag": '"1"', "server": "s", "content-length": "5"}, "d1", "k"),
        (2, "revisit", "https://a.org/x?a=1&b=2", 11, 304, {"etag": 'W/"1"', "content-length": "0", "date": "now"}, None, "k"),
        (3, "response", "https://a.org/x?a=1&b=2", 12, 404, {}, "d2", "k"),
        (4, "revisit", "https://a.org/x?a=1&b=2", 13, 304, {"etag": '"2"'}, None, "k"),
        (5, "revisit", "https://a.org/y", 13, 304, None, None, "k"), (6, "revisit", None, None, 304, None, "d", "k"),
        (7, "revisit", "a.org/x?b=2&a=1", 13, 304, None, "d1", "k"),
    ]
    table = spark.createDataFrame(rows, schema)
    found = {r["record_id"]: r for r in revisits.resolve_revisits(table).collect()}
    assert {i: (r["response_id"], r["outcome"]) for i, r in found.items()} == {
        2: (1, "resolved"), 4: (1, "validator_mismatch"), 5: (None, "no_response"), 6: (None, "no_response"), 7: (1, "resolved"),
    }
    assert {e["key"]: e["value"] for e in found[2]["headers"]} == {"etag": 'W/"1"', "server": "s", "content-length": "5", "date": "now"}
    assert revisits.resolve_revisits(table.limit(0)).count() == 0


def test_a_hot_url_in_many_parts_is_carried_on(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        events = spark.range(600).selectExpr("'u' AS key", "id AS at", "id", "IF(id % 150 = 0, id, NULL) AS v")
        found = {r["id"]: r["before"] for r in revisits.as_of(events, events["v"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found == {i: (None if i == 0 else (i - 1) // 150 * 150) for i in range(600)}


def test_disguised_words_are_restored():
    model = toxicity.CharacterModel(toxicity.trigram_counts(["the moron is a stupid loser and a pathetic idiot"] * 50))
    for disguise, word in (("m0r0n", "moron"), ("st-u-p-i-d", "stupid"), ("$tupid", "stupid"), ("loooser", "loser"), ("p@thet1c", "pathetic")):
        assert toxicity.disguised(disguise) and toxicity.restore(disguise, model) == word
    assert toxicity.words_of("an i d i o t here")[-1] == b"idiot" and not toxicity.disguised("plain")


def test_words_set_apart_by_spaces_are_restored():
    plain = "you are a stupid person and i say that the moron is an idiot and a loser said so дурак ты été à la même"
    known = toxicity.Words(toxicity.CharacterModel(toxicity.trigram_counts([plain] * 50)), toxicity.features_of)
    for text, words in (
        ("you are a s t u p i d person", ["stupid"]), ("and i s t u p i d say", ["stupid"]), ("a s t u p i d m o r o n said", ["stupid", "moron"]),
        ("you st upid person", ["stupid"]), ("a s t u p 1 d person", ["stupid"]), ("ты д у р а к ты", ["дурак"]), ("la m ê m e", ["même"]),
    ):
        found = toxicity.held_by(text, known)
        assert [w for w in words if f"={w}" not in found] == [], text
    assert not any(known.joined("you are a person and i say so"))


@pytest.mark.parametrize("name", ["toxic", "quality"])
def test_scores(spark, small, name):
    module = toxicity if name == "toxic" else quality
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    odd = spark.createDataFrame([(-1, None), (-2, ""), (None, "text"), (0, "again")], "doc_id long, text string")
    found = module.score(docs.select("doc_id", "text").unionByName(odd).selectExpr("*", "1 AS label", "2 AS x"), labels).collect()
    assert len(found) == docs.count() + 4
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % module.FOLDS == (0 if name == "toxic" else 1)) for r in found if r["doc_id"] is not None)
    assert module.score(docs, labels.limit(0)).count() == docs.count()
    assert module.score(docs.limit(0), labels).count() == 0


def test_quality_on_held_out_rows(spark):
    base = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.score(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.93 * len(rows)


def test_toxicity_on_held_out_rows(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    said = [r for r in rows if r["predicted"]]
    assert sum(r["toxic"] for r in said) >= 0.95 * len(said) and len(said) >= 0.8 * sum(r["toxic"] for r in rows)
