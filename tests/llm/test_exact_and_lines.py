import hashlib
import re
from collections import defaultdict

import pytest

from shelfcast.llm import exact, lines
from shelfcast.llm.exact import ContentTable
from tests_llm_rows import edge_rows

SPACE = re.compile(r"[\x20\x09-\x0D]")


def test_content_table_compares_contents_and_freezes():
    table = ContentTable(200)
    assert [table.find(7, b"a"), table.find(7, b"b"), table.find(7, b"a")] == [0, 1, 0]
    table.find(9, b"c" * 100)
    assert table.full and table.find(9, b"d") == -1 and table.find(9, b"c" * 100) == 2
    wide = ContentTable(1 << 30)
    assert [wide.find(i % 50, b"%d" % i) for i in range(5000)] == list(range(5000))
    assert [wide.find(i % 50, b"%d" % i) for i in range(5000)] == list(range(5000))


@pytest.mark.parametrize("limits", [{}, {"bucket_bytes": 4000, "combine_bytes": 1500}])
def test_exact_duplicates_match_brute_force(edge, limits):
    groups = defaultdict(list)
    for doc_id, text, *_ in edge_rows():
        groups[SPACE.sub("", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    want = []
    for body, members in groups.items():
        best = min(members)
        want += [(m[3], best[3], len(members), hashlib.sha256(body.encode()).hexdigest()) for m in members]
    rows = exact.exact_duplicates(edge, **limits).collect()
    got = [(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r.kept for r in rows) == len(groups)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_exact_duplicates_of_nothing(empty):
    assert exact.exact_duplicates(empty).collect() == []


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def brute_lines(rows, min_chars, min_docs):
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    holders = defaultdict(set)
    for doc_id, text, *_ in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc_id)
    shared = {k: max((d for d in ids if d is not None), default=None) for k, ids in holders.items()
              if len(k) >= min_chars and len(ids) >= min_docs}
    out = []
    for doc_id, text, *_ in rows:
        all_lines = (text or "").split("\n")
        left = [x for x in all_lines if not (key(x) in shared and (doc_id is None or doc_id != shared[key(x)]))]
        out.append((doc_id, len(all_lines), len(all_lines) - len(left), "\n".join(left)))
    return sorted(out, key=repr)


def test_lines_match_brute_force(spark, edge):
    got = [tuple(r) for r in lines.drop_shared_lines(edge).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()]
    # The two rows without an id are one document; they share no long line here.
    assert sorted(got, key=repr) == brute_lines(edge_rows(), 40, 5)
    boiler = "Cookie SETTINGS, Terms and É-Privacy of this fine site"
    rows = [(i, f"line {i}\n {boiler.lower() if i % 2 else boiler}\t\nend\n{boiler}\r\n" if i < 9 else boiler, None, None, None)
            for i in range(12)]
    df = spark.createDataFrame(rows, edge.select("doc_id", "text", "lang", "source", "n_chars").schema)
    got = [tuple(r) for r in lines.drop_shared_lines(df).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()]
    want = brute_lines(rows, 40, 5)
    assert sorted(got, key=repr) == want and any(w[2] for w in want)


def test_lines_of_nothing(empty):
    assert lines.drop_shared_lines(empty).collect() == []
