"""Repeated strings and shared passages against brute force."""

import random
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from odd_rows import ODD

from tradeflow.llm import chain_dedup, lpf_dedup, queries
from tradeflow.session import ensure_checkpoint_dir


def brute_marks(texts, length, first_stays):
    places = defaultdict(list)
    for i, t in enumerate(texts):
        for s in range(len(t) - length + 1):
            places[t[s:s + length]].append((i, s))
    out = []
    for i, t in enumerate(texts):
        marks = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            own = places[t[s:s + length]]
            if len(own) > 1 and not (first_stays and own[0] == (i, s)):
                marks[s:s + length] = True
        out.append(marks)
    return out


def repeat_rows():
    rng = random.Random(1)
    base = ["".join(rng.choice("abcdefgh ij") for _ in range(1500)) for _ in range(4)]
    texts = ["aaaa" * 150, "ab" * 200, "abc " * 90 + "x" + "abc " * 80, "", None, "short", *base[:1] * 3]
    for _ in range(40):
        x = rng.choice(base)
        a = rng.randint(0, 1200)
        own = list(x[a:a + rng.randint(150, 420)])
        for _ in range(rng.randint(0, 2)):
            own[rng.randrange(len(own))] = "é"
        texts.append("".join(rng.choice("qwertz") for _ in range(rng.randint(0, 60))) + "".join(own))
    return list(enumerate(texts))


@pytest.mark.parametrize("group_bytes", [1 << 20, 500])
@pytest.mark.parametrize("keep_first", [False, True])
def test_cut_repeats_matches_brute_force(documents, monkeypatch, group_bytes, keep_first):
    monkeypatch.setattr(lpf_dedup, "GROUP_BYTES", group_bytes)
    rows = repeat_rows()
    got = {r.doc_id: r for r in lpf_dedup.cut_repeats(documents(rows, 1), keep_first=keep_first).collect()}
    texts = [(t or "").encode() for _, t in rows]
    for i, (t, marks) in enumerate(zip(texts, brute_marks(texts, 200, keep_first))):
        assert bytes(got[i].kept) == bytes(np.frombuffer(t, np.uint8)[~marks]), i
        assert len(got[i].spans) == int((np.diff(np.concatenate([[0], marks.astype(int)])) == 1).sum()) and got[i].n_bytes == len(t)


def test_hot_grams_take_the_combining_way(documents, monkeypatch):
    rows = repeat_rows() + [(500 + i, "tail of all rows " * 20) for i in range(60)]
    plain = sorted((r.doc_id, bytes(r.kept)) for r in lpf_dedup.cut_repeats(documents(rows, 2)).collect())
    monkeypatch.setattr(lpf_dedup, "HOT_GRAM", 3)
    monkeypatch.setattr(lpf_dedup, "HOT_SHARE", 10 ** 9)
    assert sorted((r.doc_id, bytes(r.kept)) for r in lpf_dedup.cut_repeats(documents(rows, 2)).collect()) == plain


def test_factors_match_their_definition():
    rng = np.random.default_rng(2)
    for _ in range(20):
        s = rng.integers(1, 4, int(rng.integers(1, 120)))
        order, levels = lpf_dedup.suffix_array(s, 256)
        factors = lpf_dedup.longest_previous_factors(order, lpf_dedup.common_prefixes(order, levels))
        for i in range(len(s)):
            longest = max((next((k for k in range(len(s) - i) if s[j + k] != s[i + k]), len(s) - i) for j in range(i)), default=0)
            assert factors[i] // 4 == longest // 4, (s, i)


def test_odd_rows_and_empty_table(documents):
    got = lpf_dedup.cut_repeats(documents(ODD)).collect()
    assert len(got) == len(ODD) and {bytes(r.kept) for r in got if r.doc_id in (7, 9)} == {b""}
    assert lpf_dedup.cut_repeats(documents(ODD).where("false")).count() == 0
    assert {r.doc_id for r in chain_dedup.shared_passages(documents(ODD)).collect()} == {7}
    assert chain_dedup.shared_passages(documents(ODD), inside=False).count() == 0
    twice = chain_dedup.shared_passages(documents(ODD + [(70, ODD[8][1])], 1), inside=False).collect()
    assert [(r.doc_id, r.ref_doc_id, r.word_start, r.word_stop, r.identity) for r in twice] == [(70, 7, 0, 90_000, 1.0)]
    assert chain_dedup.shared_passages(documents(ODD).where("false")).count() == 0


def test_planted_passages_are_found_and_clean_documents_left_alone(documents):
    rng = random.Random(3)
    voc = [f"w{i}" for i in range(5000)]
    texts = {n: [rng.choice(voc) for _ in range(n)] for n in (51, 60, 80, 150, 400)}
    rows, truth = [], {}
    for i in range(120):
        own = [rng.choice(voc) for _ in range(rng.randint(0, 200))]
        if i % 2 == 0:
            n = rng.choice(list(texts))
            planted = list(texts[n])
            if n >= 150 and i % 4 == 0:
                planted[n // 2] = f"edit{i}"
            at = rng.randint(0, len(own))
            own[at:at] = planted
            truth[i] = (n, at)
        rows.append((i, " ".join(own).upper() if i % 6 == 0 else " ".join(own)))
    found = chain_dedup.shared_passages(documents(rows)).collect()
    assert {r.doc_id for r in found} | {r.ref_doc_id for r in found} == set(truth)
    for r in found:
        (n, at), (m, ref_at) = truth[r.doc_id], truth[r.ref_doc_id]
        assert n == m and r.word_start - at == r.ref_start - ref_at and r.identity >= 0.8 and r.similarity >= 0.8
        assert at - 5 <= r.word_start and r.word_stop <= at + n + 5


def test_repeats_inside_one_document(documents):
    words = [f"w{i}" for i in range(60)]
    docs = documents([(1, " ".join([*words, "between", *words])), (2, "other text")])
    assert chain_dedup.shared_passages(docs, inside=False).count() == 0
    found = chain_dedup.shared_passages(docs).collect()
    assert [(r.doc_id, r.ref_doc_id, r.word_start, r.word_stop, r.ref_start) for r in found] == [(1, 1, 61, 121, 0)]


def test_minimizers_are_the_least_of_every_window():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5, 16, 17, 40, 300):
        for window in (1, 2, 3, 12, 16, 24):
            grams = rng.integers(0, 1 << 62, n).astype(np.uint64)
            got = chain_dedup._minimizers(grams, window).tolist()
            want = {i + int(grams[i:i + window].argmin()) for i in range(max(n - window, 0) + 1)}
            assert got == sorted(want), (n, window)


@pytest.mark.parametrize("changed", [9, 25, 40, 55, 70])
def test_four_pieces_quoted_earlier_do_not_hide_a_changed_passage(documents, changed):
    rng = random.Random(changed)
    passage = [f"p{rng.randrange(10 ** 6)}" for _ in range(80)]
    rows = [(i, " ".join(["own", str(i), *passage[a:z], "end"])) for i, (a, z) in enumerate(((0, 24), (20, 44), (38, 62), (56, 80)))]
    other = list(passage)
    other[changed] = "changed"
    rows += [(4, " ".join(passage)), (5, " ".join(["before", *other]))]
    found = {(r.doc_id, r.ref_doc_id): r for r in chain_dedup.shared_passages(documents(rows, 1)).collect()}
    assert found[5, 4].word_start <= 1 + 9 and found[5, 4].word_stop >= 81 - 10 and set(found) == {(5, 4)}


@pytest.mark.parametrize("n, changed", [(45, None), (48, None), (61, 30), (64, 31)])
def test_quotes_that_are_too_short_do_not_hide_a_passage(documents, n, changed):
    """Every seed of the passage is first in a document that quotes under 40 words of it; copies of one text stay one class."""
    rng = random.Random(n)
    passage = [f"p{rng.randrange(10 ** 6)}" for _ in range(n)]
    rows = [(i, " ".join(["own", str(i), *passage[a:a + 30], "end", str(i)])) for i, a in enumerate(range(0, n - 25, 5))]
    last = len(rows)
    other = list(passage)
    if changed:
        other[changed] = "changed"
    lead = [f"y{rng.randrange(10 ** 6)}" for _ in range(20)]
    tail = [f"z{rng.randrange(10 ** 6)}" for _ in range(90)]
    rows += [(last, " ".join(["before", *passage, *tail])), (last + 1, " ".join([*lead, *other]))]
    rows += [(last + 2, " ".join(["before", *passage, *tail]))]
    found = {(r.doc_id, r.ref_doc_id): r for r in chain_dedup.shared_passages(documents(rows, 1)).collect()}
    assert {(last + 1, last), (last + 2, last)} == set(found)
    r = found[last + 1, last]
    assert r.word_start <= 20 + 3 and r.word_stop >= 20 + n - 3 and r.similarity >= 0.8


def test_repeats_inside_one_document_hidden_by_a_quote(documents):
    passage = [f"w{i}" for i in range(45)]
    rows = [(i, " ".join(["own", str(i), *passage[a:a + 30], "end", str(i)])) for i, a in enumerate((0, 5, 10, 15))]
    rows.append((9, " ".join([*passage, "between", *passage])))
    found = chain_dedup.shared_passages(documents(rows, 1)).collect()
    assert [(r.doc_id, r.ref_doc_id, r.word_start, r.word_stop, r.ref_start) for r in found] == [(9, 9, 46, 91, 0)]
    assert chain_dedup.shared_passages(documents(rows, 1), inside=False).count() == 0


def edited(words, edits, rng):
    out = list(words)
    for _ in range(edits):
        i, kind = rng.randrange(len(out)), rng.randrange(3)
        out[i:i + (kind != 1)] = [] if kind == 2 else [f"e{rng.randrange(10 ** 6)}"]
    return out


def test_recall_of_links_against_all_pairs(documents):
    """Passages of 60 to 140 words, with up to two edits a copy, after earlier documents have quoted pieces of them. Two
    copies whose 5-word shingles agree to 0.8 must be in one group of linked documents."""
    rng = random.Random(17)
    rows, copies = [], []
    for p in range(40):
        passage = [f"v{rng.randrange(3000)}" for _ in range(rng.randint(60, 140))]
        for _ in range(rng.randint(0, 4)):
            a = rng.randrange(len(passage) - 30)
            rows.append((len(rows), " ".join(f"x{rng.randrange(3000)}" for _ in range(30)) + " " + " ".join(passage[a:a + rng.randint(20, 38)])))
        for _ in range(4):
            own, lead = edited(passage, rng.randint(0, 2), rng), [f"y{rng.randrange(3000)}" for _ in range(rng.randint(0, 60))]
            copies.append((len(rows), p, {tuple(own[i:i + 5]) for i in range(len(own) - 4)}))
            rows.append((len(rows), " ".join(lead + own)))
    found = chain_dedup.shared_passages(documents(rows, 1)).collect()
    group = {i: i for i, _ in rows}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i
    passage_of = {i: p for i, p, _ in copies}
    for r in found:
        assert passage_of.get(r.doc_id, -1) == passage_of.get(r.ref_doc_id, -2), "a link between different passages"
        group[top(r.doc_id)] = top(r.ref_doc_id)
    pairs = [(a, b) for n, (a, p, s) in enumerate(copies) for b, q, t in copies[:n] if len(s & t) >= 0.8 * len(s | t)]
    linked = sum(top(a) == top(b) for a, b in pairs)
    print(f"links found: {linked} of {len(pairs)}")
    assert len(pairs) > 100 and linked >= 0.97 * len(pairs)


def test_thinned_cycles_cover_the_same_words(documents, monkeypatch):
    """Texts that repeat cycles of 3 to 60 words, alone, between other words and with changed words: the words that rows
    cover are the same as when no match of a cycle is left out."""
    rng = random.Random(23)
    rows = []
    for n in (3, 5, 8, 13, 25, 60):
        cycle = [f"c{n}x{i}" for i in range(n)]
        for k in range(3):
            own = (cycle * (300 // n))[rng.randrange(n):]
            own = [f"l{n}{k}{i}" for i in range(rng.randint(0, 20))] + own + [f"t{n}{k}{i}" for i in range(rng.randint(0, 20))]
            for _ in range(k):
                own[rng.randrange(len(own))] = "changed"
            rows.append((len(rows), " ".join(own)))

    def covered(inside):
        out = {}
        for r in chain_dedup.shared_passages(documents(rows, 1), inside=inside).collect():
            out.setdefault(r.doc_id, set()).update(range(r.word_start, r.word_stop))
        return out
    thinned = covered(False)
    monkeypatch.setattr(chain_dedup, "_without_cycles", lambda x, y, spans: chain_dedup._by_place(x, y, spans))
    whole = covered(False)
    assert set(thinned) == set(whole) and len(whole) >= 12
    assert all(len(whole[i] - thinned[i]) <= 2 * chain_dedup.EDIT_COST for i in whole), {i: len(whole[i] - thinned[i]) for i in whole}


def test_chains_match_quadratic_dynamic_programming():
    rng = np.random.default_rng(8)
    for _ in range(60):
        n = int(rng.integers(1, 25))
        x, y = np.sort(rng.choice(400, n, replace=False)), rng.choice(400, n, replace=False)
        best = chain_dedup.chains(x, y)
        used = [a for c in best for a in c]
        assert len(used) == len(set(used))
        for c in best:
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(c, c[1:]))

        def score(c):
            worth = sum((1 + (a[2] - chain_dedup.SEED > 0)) * chain_dedup.SEED_WORTH for a in c)
            gaps = sum((q[0] - p[0] - p[2] + chain_dedup.SEED) + (q[1] - p[1] - p[2] + chain_dedup.SEED) for p, q in zip(c, c[1:]))
            return worth - chain_dedup.GAP_COST * gaps
        if any(a[2] > chain_dedup.SEED for a in used):
            continue  # merged anchors: their worth counts seeds, not known here
        top = [chain_dedup.SEED_WORTH] * n
        for j in range(n):
            for i in range(j):
                if x[i] < x[j] and y[i] < y[j]:
                    top[j] = max(top[j], top[i] + chain_dedup.SEED_WORTH - chain_dedup.GAP_COST * (x[j] - x[i] + y[j] - y[i]))
        assert abs(max(map(score, best)) - max(top)) < 1e-9


def test_alignment_counts_kept_words():
    a, b = np.arange(100, dtype="<u2"), np.arange(100, dtype="<u2")
    b = np.concatenate([b[:40], [900, 901], b[43:]]).astype("<u2")
    start, stop, ra, rz, identity, alike = chain_dedup.align(a, b, [(10, 10, 20), (60, 59, 30)])
    assert (start, stop, ra, rz) == (0, 100, 0, 99) and abs(identity - 97 / 100) < 1e-9 and 0.8 < alike < 1


def test_pieces_quoted_earlier_do_not_part_a_passage(documents):
    rng = random.Random(12)
    voc = [f"v{i}" for i in range(20000)]
    for _ in range(3):
        passage, other = ([rng.choice(voc) for _ in range(93)] for _ in range(2))

        def around(words):
            return " ".join([*(rng.choice(voc) for _ in range(30)), *words, *(rng.choice(voc) for _ in range(30))])
        rows = [(1, around(passage[:35])), (2, around(passage[28:65])), (3, around(passage[58:])), (4, around(passage)), (5, around(passage)),
                (6, around(other[:30])), (7, around(other[30:60])), (8, around(other[:60])), (9, around(other[:60]))]
        found = chain_dedup.shared_passages(documents(rows, 1)).collect()
        assert sorted((r.doc_id, r.ref_doc_id, r.word_start, r.word_stop, r.ref_start, r.ref_stop) for r in found) == [
            (5, 4, 30, 123, 30, 123), (9, 8, 30, 90, 30, 90)]


def test_one_changed_word_at_every_place(documents):
    rng = random.Random(13)
    rows, truth = [], {}
    for n in range(51, 66):
        for place in range(n):
            words = [f"p{n}x{place}x{i}" for i in range(n)]
            changed = words[:place] + ["edit"] + words[place + 1:]
            at = [rng.randint(0, 60) for _ in range(2)]
            for k, own in enumerate((words, changed)):
                own[0:0] = [f"u{k}{n}x{place}x{i}" for i in range(at[k])]
                own += [f"t{k}{n}x{place}x{i}" for i in range(30)]
                rows.append((len(rows), " ".join(own)))
            truth[len(rows) - 1] = (n, place, at)
    found = {r.doc_id: r for r in chain_dedup.shared_passages(documents(rows, 1)).collect()}
    assert set(found) == set(truth)
    for i, (n, place, (ref_at, at)) in truth.items():
        r = found[i]
        cut = chain_dedup.EDIT_COST  # an edit outweighs fewer words beyond it
        a, z = r.word_start - at, r.word_stop - at
        assert (r.ref_doc_id, r.ref_start - ref_at, r.ref_stop - ref_at) == (i - 1, a, z), (n, place)
        assert (a == 0 or a == place + 1 <= cut) and (z == n or n - cut <= z == place), (n, place, a, z)
        assert r.identity >= 0.8 and r.similarity >= 0.8


def test_ends_of_two_lists_by_trying_all():
    rng = random.Random(14)
    for _ in range(300):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(0, 9))] for _ in range(2))
        if rng.random() < 0.5:
            b = a[:4] + b
        edits = {(0, 0): 0}
        for i in range(len(a) + 1):
            for j in range(len(b) + 1):
                if i or j:
                    before = [edits[at] + 1 for at in ((i - 1, j), (i, j - 1)) if min(at) >= 0]
                    edits[i, j] = min(before + ([edits[i - 1, j - 1] + (a[i - 1] != b[j - 1])] if i and j else []))
        best = max((i + j) / 2 - chain_dedup.EDIT_COST * e for (i, j), e in edits.items() if e <= chain_dedup.EDITS)
        i, j, kept = chain_dedup._end(a, b)
        assert (i + j) / 2 - chain_dedup.EDIT_COST * edits[i, j] == best and kept <= min(i, j)


def test_the_query_reports_repeats_inside_a_document(spark, tmp_path):
    exact, changed = [f"w{i}" for i in range(60)], [f"c{i}" for i in range(60)]
    other = changed[:30] + ["edit"] + changed[31:]
    rows = [(1, " ".join([*exact, "between", *exact])), (2, " ".join([*changed, "between", *other])), (3, "other text"), (4, "a b c " * 200)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op2_chain_dedup(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.ref_doc_id, r.word_start, r.word_stop, r.ref_start, r.ref_stop) for r in found) == [
        (1, 1, 61, 121, 0, 60), (2, 2, 61, 121, 0, 60), (4, 4, 3, 600, 0, 597)]


def test_tables_of_finished_steps_are_removed(spark, documents):
    """Seeds, slices and runs are the greatest; of all that is written only what the result reads stays, and small tables."""
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "llm"
    rng = random.Random(5)
    passage = [f"p{rng.randrange(10 ** 6)}" for _ in range(45)]
    rows = [(i, " ".join(["own", str(i), *passage[a:a + 30], "end", str(i)])) for i, a in enumerate(range(0, 20, 5))]
    rows += [(8, " ".join(["before", *passage])), (9, " ".join(["other", *passage]))]
    old = set(folder.iterdir()) if folder.exists() else set()
    found = chain_dedup.shared_passages(documents(rows, 1))
    left = {p.name.rpartition("-")[0] for p in set(folder.iterdir()) - old if any(p.iterdir())}
    assert "aligned" in left and left <= {"aligned", "heads", "again"}
    assert [(r.doc_id, r.ref_doc_id) for r in found.collect()] == [(9, 8)]


def test_seeds_of_many_texts_are_those_of_each():
    """Texts are joined to find their seeds; no seed may reach over a text's end, and texts of a window or less have one."""
    c, rng = chain_dedup, np.random.default_rng(4)
    sizes = [0, 1, 7, 8, 9, 23, 24, 31, 32, 33, 39, 40, 51, 52, 53, 79, 80, 119, 120, 121, 600, 3000]
    texts = [rng.integers(0, v, n).astype(np.uint64) for n in sizes for v in (2, 2 ** 60)]
    wanted = set()
    for t, words in enumerate(texts):
        grams = c._grams(words)
        wanted |= {(t, p, g, 8) for p in c._minimizers(grams, c.WINDOW).tolist() for g in [int(grams[p])]}
        size, level = 8, grams
        while size < 40:
            level, size = c._mixed(level, grams, size, 0xC2B2AE3D27D4EB4F, 31), size + 8
        while len(words) >= size:
            own = level[:len(words) - size + 1]
            wanted |= {(t, p, int(own[p]), size) for p in c._minimizers(own, size * 3 // 10 if size == 40 else size // 2).tolist()}
            level, size = c._mixed(level, level, size, 0xC2B2AE3D27D4EB4F, 31), 2 * size
    found = set(zip(*(v.tolist() for v in c._all_seeds(texts))))
    pairs = {f for f in found - wanted if f[1] >= 0}
    assert wanted <= found and {f[:2] for f in found - wanted - pairs} == {(t, -len(w)) for t, w in enumerate(texts) if len(w) >= 8}
    alone = set()
    for t, words in enumerate(texts):
        alone |= {(t, *f[1:]) for f in zip(*(v.tolist() for v in c._all_seeds([words])))}
    assert found == alone and pairs


def test_steps_pass_packed_rows(spark, documents):
    """Seeds, matches and runs go from step to step as columns packed for each bucket, not as a row for each (2,044 CPU seconds
    a GB when they were rows)."""
    rng, sent = random.Random(6), {}
    rows = [(i, " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(400))) for i in range(300)]
    rows += [(1000 + i, rows[i][1][:1500] + " other end") for i in range(100)]
    saved = chain_dedup.saved

    def counted(df, name, **more):
        out = saved(df, name, **more)
        sent[name] = out.count()
        return out
    chain_dedup.saved = counted
    try:
        found = {(r.doc_id, r.ref_doc_id) for r in chain_dedup.shared_passages(documents(rows)).collect()}
    finally:
        chain_dedup.saved = saved
    assert found == {(1000 + i, i) for i in range(100)}
    assert max(sent["seeds"], sent["heads"]) < 400
