"""Language-model scores, SentencePiece and page text."""

import hashlib
import math
import struct
from collections import Counter

import edge
import loops
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import sentencepiece

from loadtrail.llm import html_text, lm_scoring, sentencepiece_viterbi
from loadtrail.llm.queries import queries

SMALL = "/root/testdata/sf0.001"


def base_scores(rows):
    counts = Counter()
    for d, t in rows:
        if lm_scoring.remainder(d):
            counts.update(loops.words(loops.lowered(t)))
            counts[""] += 1
    total, distinct = sum(counts.values()), len(counts)
    found = []
    for d, t in rows:
        own = [*loops.words(loops.lowered(t)), ""]
        score = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in own)
        found.append((str(d), lm_scoring.remainder(d) == 0, len(own), sum(counts[w] > 0 for w in own), total, round(score, 6)))
    return sorted(found)


def test_base_scores(spark, monkeypatch):
    for head in (lm_scoring.HEAD_WORDS, 20):
        monkeypatch.setattr(lm_scoring, "HEAD_WORDS", head)
        found = lm_scoring.text_scores(edge.frame(spark)).collect()
        assert sorted((str(r[0]), *r[1:5], round(r["base_score"], 6)) for r in found) == base_scores(edge.texts())
        assert all(r["score"] < 0 for r in found)
    empty = edge.frame(spark).limit(0)
    assert lm_scoring.text_scores(empty).count() == 0


def test_every_training_document_has_one_round():
    for doc_id in [None, *range(500)]:
        assert sum(lm_scoring.share(doc_id) == turn for turn in range(lm_scoring.ROUNDS)) == 1


def laid_out(documents):
    return [np.concatenate(parts) for parts in zip(*lm_scoring.windows(documents))]


def test_windows_score_every_id_once(monkeypatch):
    monkeypatch.setattr(lm_scoring, "WINDOWS_AT_ONCE", 3)
    rng = np.random.default_rng(1)
    documents = [rng.integers(0, 900, n).astype(np.uint32) for n in (0, 1, 5, 23, 24, 25, 43, 44, 45, 200)]
    inputs, targets, fresh, owner = laid_out(documents)
    for k, ids in enumerate(documents):
        scored = targets[owner == k][fresh[owner == k]]
        assert scored.tolist() == [*ids.tolist(), lm_scoring.END]
    first = np.flatnonzero(owner == 9)[0]
    assert inputs[first][0] == lm_scoring.END and (inputs[first][1:] == documents[9][: lm_scoring.WINDOW - 1]).all()


def test_windows_overlap_by_eight_ids_at_least():
    _, _, fresh, _ = laid_out([np.arange(200)])
    context = [np.flatnonzero(row) + 1 for row in fresh]
    assert max(c.max() for c in context) >= 32
    assert min(c.min() for c in context[1:]) >= 9


def test_attention_is_causal_and_a_distribution():
    net = lm_scoring.Attention.start()
    rng = np.random.default_rng(2)
    a = rng.integers(0, lm_scoring.CLASSES, (3, lm_scoring.WINDOW))
    b = a.copy()
    b[:, 20:] = rng.integers(0, lm_scoring.CLASSES, b[:, 20:].shape)
    every = np.stack([net.log_probabilities(a, np.full_like(a, c)) for c in range(lm_scoring.CLASSES)])
    assert np.allclose(np.exp(every).sum(0), 1, atol=1e-4)
    wanted = np.zeros_like(a)
    assert np.allclose(net.log_probabilities(a, wanted)[:, :20], net.log_probabilities(b, wanted)[:, :20], atol=1e-5)


def test_gradients():
    net = lm_scoring.Attention.start()
    rng = np.random.default_rng(3)
    classes, targets = rng.integers(0, lm_scoring.CLASSES, (2, 4, lm_scoring.WINDOW))
    mask = rng.random(classes.shape) < 0.8
    loss = lambda: -(net.log_probabilities(classes, targets) * mask).sum(dtype=np.float64) / mask.sum()
    for weight, gradient in zip(net.weights(), net.gradients(classes, targets, mask)):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept = weight[at]
        weight[at] = kept + 0.02
        above = loss()
        weight[at] = kept - 0.02
        below = loss()
        weight[at] = kept
        assert abs((above - below) / 0.04 - gradient[at]) < 0.05 * abs(gradient[at]) + 2e-4


def test_training_helps_on_held_out_documents():
    known = lm_scoring.WordIds(lm_scoring.vocabulary())
    table = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pydict()
    ids = [(d, known.of(lm_scoring.words_of(t))) for d, t in zip(table["doc_id"], table["text"])]
    learn, held = [x for d, x in ids if lm_scoring.remainder(d)], [x for d, x in ids if not lm_scoring.remainder(d)]
    follows = np.zeros((lm_scoring.IDS, lm_scoring.CELLS))
    for x in learn:
        y = np.concatenate(([lm_scoring.END], x, [lm_scoring.END])).astype(np.int64)
        np.add.at(follows, (y[1:], y[:-1] % lm_scoring.CELLS), 1)
    classes, in_class = lm_scoring.id_classes(follows)
    assert np.allclose(np.bincount(classes, np.exp(in_class), lm_scoring.CLASSES), 1, atol=1e-6)
    share = np.log10((follows.sum(1) + 0.1) / (follows.sum(1) + 0.1).sum())
    by_counts = sum(share[x].sum() + share[lm_scoring.END] for x in held)
    net = lm_scoring.Attention.start()
    adam = lm_scoring.Adam(net.weights())
    inputs, targets, fresh, _ = laid_out(learn[:300])
    for low in range(0, len(inputs), 128):
        part = slice(low, low + 128)
        adam.step(net.weights(), net.gradients(classes[inputs[part]], classes[targets[part]], fresh[part]))
    assert lm_scoring.Scorer(net, classes, in_class).scores(held).sum() > by_counts * 0.93


def document_batch(rows):
    return pa.RecordBatch.from_pydict({"doc_id": pa.array([d for d, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows])})


def counted(rows):
    found = np.zeros((lm_scoring.IDS, lm_scoring.CELLS))
    for batch in lm_scoring.count_ids(lm_scoring.vocabulary())(iter([document_batch(rows)])):
        for block, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            own = np.frombuffer(counts).reshape(-1, lm_scoring.CELLS)
            found[block * lm_scoring.BLOCK_IDS :][: len(own)] = own
    return found


def test_ids_are_counted_in_running_texts():
    rows = [(d, t) for d, t in enumerate(["red cat sat", "the red cat", "", "a Red  hat sat", "held out maybe"] * 4)]
    known = lm_scoring.WordIds(lm_scoring.vocabulary())
    wanted = np.zeros((lm_scoring.IDS, lm_scoring.CELLS))
    for d, t in rows:
        if lm_scoring.remainder(d):
            ids = [lm_scoring.END, *known.of(lm_scoring.words_of(t)).tolist(), lm_scoring.END]
            for a, b in zip(ids, ids[1:]):
                wanted[b, a % lm_scoring.CELLS] += 1
    assert (counted(rows) == wanted).all()
    cat, red = known.of([b"cat"])[0], known.of([b"red"])[-1]
    assert wanted[cat, red % lm_scoring.CELLS] > 0 and wanted[cat, lm_scoring.END % lm_scoring.CELLS] == 0


def started_ids(seed=4):
    rng = np.random.default_rng(seed)
    follows = rng.integers(0, 3, (lm_scoring.IDS, lm_scoring.CELLS)).astype(float)
    ids = lm_scoring.Ids(*lm_scoring.id_classes(follows))
    for table in ids.tables:
        table += rng.normal(0, 0.5, table.shape).astype(np.float32)
    return ids, rng


def test_ids_are_a_distribution_that_depends_on_the_context():
    ids, rng = started_ids()
    net = lm_scoring.Attention.start()
    every = np.arange(lm_scoring.IDS)
    found = []
    for state in rng.normal(0, 1, (2, lm_scoring.WIDTH)).astype(np.float32):
        h = np.repeat(state[None], len(every), 0)
        inside = ids.log_probabilities(every, h)
        assert np.allclose(np.bincount(ids.classes, np.exp(inside), lm_scoring.CLASSES), 1, atol=1e-3)
        assert abs(np.exp(inside + net.of_classes(h, ids.classes)).sum() - 1) < 1e-3
        found.append(inside)
    assert np.abs(found[0] - found[1]).max() > 0.1


def test_gradients_of_single_ids():
    ids, rng = started_ids()
    targets, h = rng.integers(0, lm_scoring.IDS, 40), rng.normal(0, 1, (40, lm_scoring.WIDTH)).astype(np.float32)
    targets[20:] = targets[:20]
    dh, (nodes, sums, times) = ids.gradients(targets, h)
    loss = lambda: -ids.log_probabilities(targets, h).sum()
    assert times.sum() == ids.sizes[targets].sum()
    for weight, gradient in ((h, dh), (ids.tables[1], np.zeros_like(ids.tables[1]))):
        if weight is not h:
            gradient[nodes] = sums
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept = weight[at]
        weight[at] = kept + 0.02
        above = loss()
        weight[at] = kept - 0.02
        below = loss()
        weight[at] = kept
        assert abs((above - below) / 0.04 - gradient[at]) < 0.02 * abs(gradient[at])


def test_a_round_learns_which_word_follows_inside_a_class(monkeypatch):
    """Ids with equal counts: neither their class nor their share in it says which one follows."""
    monkeypatch.setattr(lm_scoring, "BATCH", 8)
    rng = np.random.default_rng(7)
    words = [w for w in "cat dog hat sun map pen box cup fan key bed car bus hen pig ant bee cow fox owl".split()]
    follow = dict(zip(words, np.roll(words, 7).tolist()))
    rows = []
    for d in range(2000):
        first = [words[k] for k in rng.integers(0, len(words), 12)]
        rows.append((d, " ".join(x for w in first for x in (w, follow[w]))))
    classes, in_class = lm_scoring.id_classes(np.zeros((lm_scoring.IDS, lm_scoring.CELLS)))
    known = lm_scoring.WordIds(lm_scoring.vocabulary())
    ids, flat = lm_scoring.Ids(classes, in_class), lm_scoring.Attention.start().flat()

    class Given:
        def __init__(self, value):
            self.value = value

    for turn in range(lm_scoring.ROUNDS):
        run = lm_scoring.train(lm_scoring.vocabulary(), Given(ids), Given(flat), turn)
        sums = {}
        for batch in lm_scoring.add_blocks(run(iter([document_batch(rows)]))):
            sums.update((b, np.frombuffer(c)) for b, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        weights = np.concatenate([sums[k] for k in sorted(sums) if k >= 0])
        flat = weights[:-1] / weights[-1]
        lm_scoring.move_rows(ids.tables, sums)
    scorer = lm_scoring.Scorer(lm_scoring.Attention.of_flat(flat), classes, in_class, ids)
    right = [known.of([w.encode(), follow[w].encode()]) for w in words]
    wrong = [known.of([w.encode(), follow[follow[w]].encode()]) for w in words]
    assert scorer.scores(right).sum() > scorer.scores(wrong).sum() + 0.2 * len(words)


class Held:
    def __init__(self, value):
        self.value = value


def test_documents_are_encoded_once_and_learnt_from_as_texts_are():
    rows = [(d, t) for d, t in enumerate(["red cat sat", "the  Red cat", "", "a red hat\u3000 \u3000sat", "Held out maybe"] * 8)]
    encoded = list(lm_scoring.encode_documents(lm_scoring.vocabulary())(iter([document_batch(rows)])))
    documents = encoded[0].to_pydict()
    assert documents["text"] == [t for _, t in rows]
    known = lm_scoring.WordIds(lm_scoring.vocabulary())
    assert [np.frombuffer(x, lm_scoring.ID).tolist() for x in documents["ids"]] == [
        known.of(lm_scoring.words_of(t)).tolist() for _, t in rows
    ]
    assert documents["turn"] == [lm_scoring.share(d) if lm_scoring.remainder(d) else None for d, _ in rows]
    words = Counter()
    for d, t in rows:
        if lm_scoring.remainder(d):
            words.update([*lm_scoring.words_of(t), b""])
    assert dict(zip(encoded[1].to_pydict()["word"], encoded[1].to_pydict()["n"])) == words

    classes, in_class = lm_scoring.id_classes(np.zeros((lm_scoring.IDS, lm_scoring.CELLS)))
    ids, flat = lm_scoring.Ids(classes, in_class), lm_scoring.Attention.start().flat()
    for run in (lm_scoring.count_ids(lm_scoring.vocabulary()), lm_scoring.train(lm_scoring.vocabulary(), Held(ids), Held(flat), 1)):
        from_ids, from_texts = (
            [b.to_pydict() for b in run(iter([batch]))] for batch in (encoded[0].select(["doc_id", "ids"]), document_batch(rows))
        )
        assert from_ids and from_ids == from_texts


def test_words_in_use_are_encoded_once(monkeypatch):
    monkeypatch.setattr(lm_scoring, "CACHED_WORDS", 4)
    known, plain = lm_scoring.WordIds(lm_scoring.vocabulary()), lm_scoring.WordIds(lm_scoring.vocabulary())
    calls, encode = Counter(), known.encode
    known.encode = lambda text: (calls.update([text]), encode(text))[1]
    for k in range(40):
        assert known.of([b"red", b"hat%d" % k, b""]).tolist() == [
            *plain.encode(" red"), *plain.encode(" hat%d" % k), lm_scoring.END
        ]
        assert len(known) + len(known.before) <= 2 * lm_scoring.CACHED_WORDS
    assert calls[" red"] == 1


def test_places_that_no_target_needs_are_only_attended_to(monkeypatch):
    """The windows that go on with a document give the same gradients as if every place had a state, with fewer states."""
    rng = np.random.default_rng(6)
    inputs, targets, fresh, _ = laid_out([rng.integers(0, 900, n).astype(np.uint16) for n in (0, 3, 31, 40, 90, 3000)])
    ids, _ = started_ids()
    asked = []
    attend = lm_scoring.Attention.attend

    def counting(self, x, skip=0):
        found = attend(self, x, skip)
        asked.append(found[0].size // lm_scoring.WIDTH)
        return found

    monkeypatch.setattr(lm_scoring.Attention, "attend", counting)

    def learnt():
        net, own = lm_scoring.Attention.start(), lm_scoring.copy.deepcopy(ids)
        adam, steps = lm_scoring.Adam(net.weights()), lm_scoring.RowSteps(own)
        for _ in range(3):
            lm_scoring.learn_batch(net, adam, own, steps, inputs, targets, fresh)
        return [net.flat(), *own.tables, *steps.met]

    def whole(mask):
        return [(np.arange(len(mask)), 0, np.flatnonzero(mask))]

    found = learnt()
    fewer = sum(asked)
    monkeypatch.setattr(lm_scoring, "window_groups", whole)
    asked.clear()
    for a, b in zip(found, learnt()):
        assert np.allclose(a, b, atol=2e-4)
    assert fewer < sum(asked) * 0.85


def unigram_model(pieces: sentencepiece_viterbi.Vocabulary) -> bytes:
    """The same pieces and scores as a model file of the library's own unigram type."""

    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    def field(number, payload):
        return varint(number << 3 | 2) + varint(len(payload)) + payload

    score = dict(zip(pieces.ids.tolist(), pieces.scores.tolist()))
    model = b""
    for k, piece in enumerate(pieces.pieces):
        kind = 2 if k == 0 else 6 if k in pieces.bytes_of else 3 if k in (1, 2) else 1
        own = field(1, piece.encode()) + varint(2 << 3 | 5) + struct.pack("<f", score.get(k, 0.0) if kind == 1 else 0.0)
        model += field(1, own + varint(3 << 3) + varint(kind))
    trainer = varint(3 << 3) + varint(1) + varint(35 << 3) + varint(1)  # unigram, byte fallback
    rules = field(1, b"identity") + varint(3 << 3) + varint(1) + varint(4 << 3) + varint(0) + varint(5 << 3) + varint(1)
    return model + field(2, trainer) + field(3, rules)


def test_viterbi_equals_the_library_on_the_same_pieces():
    pieces = sentencepiece_viterbi.vocabulary(sentencepiece_viterbi.public_model())
    library = sentencepiece.SentencePieceProcessor(model_proto=unigram_model(pieces))
    texts = pq.read_table(f"{SMALL}/documents.parquet")["text"].to_pylist() + ["  two  spaces ", "日本語 текст 🙂 ñandú", "a\nb\tc"]
    for text, ids in zip(texts, pieces.encode(texts)):
        assert pieces.decode(ids.tolist()) == text
        scores = [sum(library.get_score(k) if k not in pieces.bytes_of else 0 for k in x) for x in (ids.tolist(), library.encode(text))]
        assert ids.tolist() == library.encode(text) or abs(scores[0] - scores[1]) < 0.01, text[:80]


def test_encoding_and_decoding_tables(spark):
    docs = edge.frame(spark)
    tokens = sentencepiece_viterbi.encoded(docs)
    found = sorted((str(r["doc_id"]), r["text"]) for r in sentencepiece_viterbi.decoded(tokens).collect())
    assert found == sorted((str(d), t or "") for d, t in edge.texts())
    assert sentencepiece_viterbi.encoded(edge.nothing(spark)).count() == 0
    assert queries()["op4_sentencepiece"](spark, SMALL).where("n_ids = 0").count() == 0


def test_the_query_decodes_what_it_encodes(spark):
    found = queries()["op4_sentencepiece"](spark, SMALL).collect()
    texts = dict(zip(*pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pydict().values()))
    assert len(found) == len(texts) and all(r["round_trip"] for r in found)
    assert all(r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest() for r in found)
    odd = edge.frame(spark, [(1, "a\u2581b"), (2, None), (3, "a b")])
    assert {r["doc_id"]: r["round_trip"] for r in sentencepiece_viterbi.round_trips(odd).collect()} == {1: False, 2: True, 3: True}


PAGES = {
    "": "",
    "<p>": "",
    "<article><h1>Title</h1><p>It is the <b>best of</b> all&nbsp;the days &amp; it was so for all of us in the town.<br>Yes</article>": (
        "Title It is the best of all the days & it was so for all of us in the town. Yes"
    ),
    "<nav><ul><li><a href='/a'>the</a></ul></nav><article><p>Short</p></article><footer>the end of it</footer>": "Short",
    "<article><p>One</p><div class='share-box'><p>the of and</p></div><p>Two</p><aside>x</aside></article>": "One Two",
    "<div class=\"ad\">the of<article><p>Kept a &lt;tag&gt;</p></article>": "Kept a <tag>",
    "<article><p>x<script>var a = '</p>';</script>y<!-- no --></p></article><div id=comments><p>the reader was here</p></div>": "xy",
    "<main><p>Text of it</p><article class='comment'><p>the reader of it</p></article><p>end</p></main>": "Text of it end",
    "<article><p>A</p></article><section id='comments'><article><p>the reader of it</p></article></section>": "A",
    "<body><div><a href=x>the one</a></div><p>It was the first of the days in the year and it is to be the last of them for us.</p><p>tail</p></body>": (
        "It was the first of the days in the year and it is to be the last of them for us. tail"
    ),
}


def test_page_text():
    for page, text in PAGES.items():
        assert html_text.main_text(page) == text, page


def test_names_of_boxes_weigh_and_density_decides():
    prose = "It was the first of the days in the year and it is to be the last of them for us. " * 3
    prose = prose.strip()
    links = "<a href=x>the one of it and the other</a> " * 6
    wanted = {
        f"<article class='post comments-open'><p>{prose}</p></article>": prose,
        f"<div id=page class='no-sidebar has-banner'><div class=x><p>{prose}</p></div></div>": prose,
        f"<div class='share-page'><p>{prose}</p><p>the of</p></div>": prose,
        f"<article><p>A</p><div class='social'><div>the of</div><div class=ad>{prose}</div>{links}</div><p>B</p></article>": "A B",
        f"<article><p>A</p><div class=search><div class=ad><div>{prose}</div></div><p>find it</p></div><p>B</p></article>": "A B",
        f"<div class='comments open'><p>{prose}</p></div><article><p>A</p></article>": "A",
        f"<article class='comment'><p>{prose}</p></article><article><p>A</p></article>": "A",
        f"<div class='cookie-notice no-js'><p>{prose}</p></div><main><p>A</p></main>": "A",
        f"<article><div class=toolbar><p>x</p><p>A {prose}": f"A {prose}",
    }
    for page, text in wanted.items():
        assert html_text.main_text(page) == text, page


def test_a_very_long_page():
    body = "".join(f"<p>It was day {k} of the year and all of it was as it is to be for us in the town.</p>" for k in range(20_000))
    text = html_text.main_text(f"<nav>{'<a>x</a>' * 20_000}</nav><article>{body}</article>{'<div class=ad>the of</div>' * 20_000}")
    assert text.startswith("It was day 0 of") and text.count("It was day") == 20_000 and "the of" not in text


def test_pages_table(spark):
    rows = [(k, f"http://x/{k}", page, "clash") for k, page in enumerate(PAGES)] + [(None, None, None, "clash")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in html_text.extracted(docs).collect()}
    wanted = dict(enumerate(PAGES.values())) | {None: ""}
    assert found == {k: (t, len(t)) for k, t in wanted.items()}
    assert html_text.extracted(docs.limit(0)).count() == 0


def test_pages_of_the_test_tables(spark):
    import html
    import re

    for row in queries()["op6_html_extraction"](spark, SMALL).join(
        spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "html"), "page_id"
    ).collect():
        article = re.search(r"<article>(.*?)</article>", row["html"], re.DOTALL)[1]
        assert row["text"] == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", article)).split())
