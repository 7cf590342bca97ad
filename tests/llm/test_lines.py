import pytest

from tastegrid.llm import lines
from tests.llm.fixtures import odd_rows, table


def by_hand(docs, least):
    sites = {}
    for _, text, _, source, _ in docs:
        for line in (text or "").split("\n"):
            if source is not None and line.strip(" "):
                sites.setdefault(line.strip(" "), set()).add(source)
    bad = {line for line, s in sites.items() if len(s) >= least}
    out = []
    for doc_id, text, *_ in docs:
        if text is None:
            out.append((str(doc_id), None, 0, 0))
            continue
        parts = text.split("\n")
        kept = [p for p in parts if p.strip(" ") not in bad]
        out.append((str(doc_id), "\n".join(kept), len(parts), len(parts) - len(kept)))
    return sorted(out, key=str)


def found(spark, docs, least, **more):
    out = lines.remove_boilerplate(table(spark, docs, clashes=True), least, **more)
    return sorted(((str(r["doc_id"]), r["text"], r["n_lines"], r["n_removed"]) for r in out.collect()), key=str)


def many_sites(sites=40):
    docs = []
    for s in range(sites):
        for k in range(4):
            shared = [f"on {n} sites" for n in range(1, sites + 1) if s < n]
            docs.append((s * 10 + k, "\n".join(["hot line", *shared, f"own {s} {k}", "", "  hot line "]), "en", f"s{s}", 1))
    return docs


@pytest.mark.parametrize("least", [1, 2, 3])
def test_odd_rows(spark, least):
    assert found(spark, odd_rows(), least) == by_hand(odd_rows(), least)


@pytest.mark.parametrize("least", [5, 20, 40])
def test_near_the_threshold(spark, least):
    # coarse sketches: the exact count of the band must mend their errors
    assert found(spark, many_sites(), least, log_k=8, band=0.4) == by_hand(many_sites(), least)


def test_empty(spark):
    assert found(spark, [], 2) == []
