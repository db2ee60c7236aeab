"""Filter audit, vector codes and language identification: SQL, brute force, held-out accuracy, awkward rows."""

from __future__ import annotations

import itertools
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from check import canonical
from commerce_engine.llm import filter_audit, languages, queries, vector_codes

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, mask int, part string, n bigint"
LABELS = "doc_id bigint, quality int, toxic int, lang string, good int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, g, "s", 0, 9, "x", 1) for i, t, g in rows], DOCS)


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_vector_codes"])
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = [d[0] for d in want.description]
    got = queries.QUERIES[name](spark, FOLDER)
    assert canonical(got.columns, [tuple(r) for r in got.collect()], 0) == canonical(columns, want.fetchall(), 0)


# ------------------------------------------------------------ 11 filter audit
def audit_by_hand(rows, labels):
    text = {}
    for i, t, _ in rows:
        if i is not None:
            text[t or ""] = min(i, text.get(t or "", i))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    cells = Counter()
    for i, t, lang in rows:
        t = t or ""
        words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in t).split(" ") if w]
        fails = (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
            any(c in "#$%&*|" for c in t), i is not None and text[t] < i,
        )
        cells[lang or "", fails, i in good, i in toxic] += 1
    out = {}
    for part in {lang or "" for _, _, lang in rows}:
        removed = Counter()
        for order in permutations(range(5)):
            for step, f in enumerate(order):
                row = [0] * 6
                for (p, fails, g, x), n in cells.items():
                    if p != part:
                        continue
                    gone = any(fails[e] for e in order[:step])
                    row[0] += n * (not gone and not fails[f])
                    row[1] += n * (not gone and fails[f])
                    row[2] += n * (gone and fails[f])
                    row[3] += n * (fails[f] and sum(fails) == 1)
                    row[4] += n * g * (not gone and fails[f])
                    row[5] += n * x * (not gone and fails[f])
                removed[f] += row[1]
                out[part, "".join("ABCDE"[e] for e in order), step + 1] = row
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed["ABCDE".index(order[step - 1])])
    return out


def test_audit_awkward_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (5, "same", "en"), (2, "same", "de"), (2, "same", "en"), (None, "same", "en"), (9, None, None), (10, "", ""), (11, "", "en"),
        (12, long, "en"), (13, long, "en"), (14, "A B C " * 100, "fr"), (15, "a#b\x0bc d é", "fr"), (None, None, None),
    ]
    labels = [(2, 1, 0), (2, None, 1), (5, 1, None), (13, 1, 1), (None, 1, 1), (77, 1, 1)]
    got = filter_audit.audit(docs(spark, rows), spark.createDataFrame([(*x, "zz", 7) for x in labels], LABELS))
    assert got.columns == ["part", "filter_order", "step", *filter_audit.COUNTS, "shapley"]
    assert [t for c, t in got.dtypes[3:]] == ["bigint"] * 7 and dict(got.dtypes)["step"] == "int"
    assert {tuple(r[:3]): list(r[3:]) for r in got.collect()} == audit_by_hand(rows, labels)
    assert filter_audit.audit(docs(spark, rows).limit(0), spark.createDataFrame([], LABELS)).count() == 0


def test_copies_reach_the_shuffle_as_one_row_a_partition(spark):
    many = docs(spark, [(1, "copy", "en")]).selectExpr("explode(sequence(0L, 19999L)) doc_id", "text", "lang").repartition(4)
    cells = filter_audit.cells(many, spark.createDataFrame([], LABELS)).collect()
    assert sorted((r["mask"], r["n"]) for r in cells) == [(1, 1), (17, 19_999)]


# ------------------------------------------------------------- 12 vector codes
def nearest(x, book):
    return ((x[:, None, :] - book[None]) ** 2).sum(2).argmin(1)


@pytest.mark.parametrize("n,width,entries,spread", [(1, 3, 1, 5), (9, 1, 4, 3), (300, 2, 20, 40), (600, 5, 64, 6), (900, 16, 100, 500)])
def test_trees_assign_exactly(n, width, entries, spread):
    rng = np.random.default_rng(n)
    x = rng.integers(-spread, spread, (n, width))
    book = np.concatenate([x[:entries], x[: entries // 3]])  # equal entries: the lower index wins
    tree = vector_codes.Tree.unpack(vector_codes.grow(x).pack())
    assert sorted(tree.order) == list(range(n)) and (tree.points == x[tree.order]).all()
    for c, r, a, b in zip(tree.center, tree.radius, tree.lo, tree.hi):
        assert a <= c < b and r + 1e-9 >= np.sqrt(((tree.points[a:b] - tree.points[c]) ** 2).sum(1)).max()
    for c, k in zip(tree.child, tree.children):
        if k:  # siblings are separated, and their ranges make up the parent's
            middle = tree.points[tree.center[c : c + k]].astype(float)
            apart = np.sqrt(((middle[:, None] - middle[None]) ** 2).sum(2)) + np.eye(k) * 1e9
            assert apart.min() > 0
    code, _ = vector_codes.assign(tree, book)
    assert (code == nearest(tree.points.astype(np.int64), book)).all()
    count, sums = vector_codes.run_sums(tree, code, len(book))
    for e in range(len(book)):
        assert count[e] == (code == e).sum() and (sums[e] == tree.points[code == e].sum(0)).all()


def test_tight_groups_are_assigned_as_whole_subtrees():
    rng = np.random.default_rng(4)
    heads = rng.integers(-4000, 4000, (40, 8))
    x = (heads[:, None] + rng.integers(-3, 4, (40, 50, 8))).reshape(-1, 8)
    tree = vector_codes.grow(x)
    code, compared = vector_codes.assign(tree, heads)
    assert (code == nearest(tree.points.astype(np.int64), heads)).all()
    assert compared < len(x) * len(heads) / 5


def codes_by_hand(rows, entries=256, rounds=4):
    kept = [r for r in rows if r[1] is not None and all(v is not None and np.isfinite(v) for v in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(4, -(-max(len(r[1]) for r in kept) // 4) * 4)
    x = np.array([[int(np.floor(1024 * v)) for v in r[1]] + [0] * (width - len(r[1])) for r in kept])
    parts = np.split(x, 4, axis=1)
    books = [p[:entries].copy() for p in parts]
    for _ in range(rounds):
        for p, b in zip(parts, books):
            code = nearest(p, b)
            for e in set(code):
                b[e] = p[code == e].sum(0) // (code == e).sum()
    codes = [nearest(p, b) for p, b in zip(parts, books)]
    error = sum(((p - b[c]) ** 2).sum(1) for p, b, c in zip(parts, books, codes))
    by_label = defaultdict(int)
    for r, e in zip(kept, error):
        by_label[r[2]] += int(e)
    sha = vector_codes.digest(books)
    return sorted((str(r[0]), bytes(int(c[i]) for c in codes).hex(), int(error[i]), by_label[r[2]], sha) for i, r in enumerate(kept))


def test_codes_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "ROWS", 64)
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(v)) for v in rng.normal(size=7)], int(i) % 3) for i in rng.permutation(700)]
    rows += [(5, rows[0][1], None), (5, rows[1][1], None), (None, rows[2][1], 1), (800, [0.25], 2), (801, [], 2)]
    rows += [(900 + k, v, 1) for k, v in enumerate([None, [None, 1.0], [float("nan")] * 7, [float("inf")] + [0.0] * 6])]
    rows += [(2000 + i, rows[0][1], 1) for i in range(300)]  # copies
    table = spark.createDataFrame([(i, v, k, "x", 3) for i, v, k in rows], "vec_id bigint, embedding array<float>, label int, code string, error int")
    got = vector_codes.compressed(table)
    assert dict(got.dtypes) == {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == codes_by_hand(rows)
    assert vector_codes.compressed(table.limit(0)).count() == 0 == vector_codes.compressed(table.where("vec_id = 900")).count()


# --------------------------------------------------------------- 13 languages
@pytest.mark.parametrize("n,labels,stretch", [(1, 3, 64), (5, 3, 2), (7, 2, 3), (6, 3, 4), (4, 1, 64)])
def test_forward_backward_equals_all_paths(monkeypatch, n, labels, stretch):
    monkeypatch.setattr(languages, "STRETCH", stretch)
    rng = np.random.default_rng(n)
    score, start, move = rng.normal(size=(n, labels)), rng.random(labels), rng.random((labels, labels))
    first = rng.random(n) < 0.3
    first[0] = True
    both, moves, total = np.zeros((n, labels)), np.zeros((labels, labels)), 0.0
    for path in itertools.product(range(labels), repeat=n):
        p = np.exp(score[np.arange(n), path].sum())
        for i in range(n):
            p *= start[path[i]] if first[i] else move[path[i - 1], path[i]]
        total += p
        both[np.arange(n), path] += p
        for i in np.flatnonzero(~first):
            moves[path[i - 1], path[i]] += p
    got = languages.forward_backward(score, first, start, move)
    assert np.allclose(got[0], both / total) and np.allclose(got[1], moves / total)


@pytest.fixture(scope="module")
def documents(spark):
    from commerce_engine.llm.common import table

    return table(spark, FOLDER, "documents")


@pytest.fixture(scope="module")
def model(documents):
    return languages.fit(documents)


def test_languages_of_held_out_documents(spark, documents, model):
    rows = languages.identified(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == documents.count()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0}
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_held_out_rows_change_nothing(spark, documents):
    """Held-out languages, sources and ids are no input: only text tells."""
    spoiled = documents.selectExpr("doc_id", "text", "if(crc32(cast(cast(doc_id as string) as binary)) % 5 = 0, 'zz', lang) lang", "'s' source")
    a = languages.identified(documents).select("doc_id", "lang_pred", "score")
    b = languages.identified(spoiled).select("doc_id", "lang_pred", "score")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_switches_inside_a_text_are_found(spark, documents, model):
    """Pieces of held-out texts of two languages, joined: most words get their own language."""
    held = [r for r in documents.where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0 and length(text) > 400").collect()]
    by = defaultdict(list)
    for r in sorted(held, key=lambda r: r["doc_id"]):
        by[r["lang"]].append(" ".join(r["text"].split()[:40]))
    pairs = [(x, y) for x in sorted(by) for y in sorted(by) if x != y]
    rows = [(i, by[x][0] + " ; " + by[y][0], None) for i, (x, y) in enumerate(pairs)]
    right = whole = 0
    for r in languages.spans(docs(spark, rows), model).collect():
        text, (x, y) = rows[r["doc_id"]][1].encode(), pairs[r["doc_id"]]
        middle = text.index(b" ; ")
        assert all(a["end"] <= b["begin"] for a, b in zip(r["spans"], r["spans"][1:]))
        for s in r["spans"]:
            for part, want in ((text[s["begin"] : min(s["end"], middle)], x), (text[max(s["begin"], middle) : s["end"]], y)):
                whole += len(part)
                right += len(part) * (s["lang"] == want)
    assert right > 0.9 * whole


def test_languages_awkward_rows(spark, documents, model):
    long = "the and of " * 40_000
    texts = [None, "", "123 -- 4", "“—¿ ", "ª", "日本語", "the", long, "x" * 200_000]
    rows = docs(spark, [(i, t, None) for i, t in enumerate(texts)] + [(None, "the and of", "en"), (3, "the and of", None)])
    got = languages.predicted(rows, model).collect()
    assert [r["lang_pred"] for r in got[:4]] == ["und"] * 4 and all(r["score"] == 0 for r in got[:4])
    assert all(r["lang_pred"] in model.languages for r in got[4:]) and got[7]["lang_pred"] == "en" == got[9]["lang_pred"]
    nothing = languages.identified(rows.where("lang is null"))
    assert nothing.columns == ["doc_id", "held_out", "lang_pred", "score"] and [t for _, t in nothing.dtypes] == ["bigint", "boolean", "string", "double"]
    assert {(r["lang_pred"], r["score"]) for r in nothing.collect()} == {("und", 0.0)}
    assert languages.identified(rows.limit(0)).count() == 0
    one = docs(spark, [(i, f"a b c{i}", "qq") for i in range(40)])
    assert {(r["lang_pred"], r["score"]) for r in languages.identified(one).collect()} == {("qq", 1.0)}


def test_words_are_runs_of_letters():
    column = pa.array(["Été, NAÏVE “ok” 4x ¿que?", ""])
    offsets, data = languages.buffers(column)
    w, _, _ = languages.cut(offsets, data)
    low = languages.letters_only(data).tobytes()
    assert [low[a:b].decode() for a, b in zip(w.start, w.end)] == ["été", "naïve", "ok", "x", "que"]
