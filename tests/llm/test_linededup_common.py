"""Common lines are dealt over shares: the same result, wherever the line between common and rare is."""

import pytest

from basketry.llm import linededup


@pytest.mark.parametrize("common", [1, 3, 1000])
def test_common_lines(docs_of, monkeypatch, common):
    line, near, rare = "a line that is in every text of them all " * 2, "a lime that is in every text of them all " * 2, \
        "a line that only two of the texts have, at their end" * 2
    rows = [(i, f"{line}\nnumber {i}" + (f"\n{rare}" if i in (4, 7) else ""), "en", "s", 1) for i in range(12)]
    rows += [(20, near, "en", "s", 1), (21, None, "en", "s", 1), (None, line, "en", "s", 1)]
    monkeypatch.setattr(linededup, "COMMON", common)
    got = {r.doc_id: (r.text, r.lines_found.n_removed) for r in linededup.dedup_lines(docs_of(rows)).collect()}
    want = {i: (f"number {i}" + (f"\n{rare}" if i == 4 else ""), 1 + (i == 7)) for i in range(1, 12)}
    # the near line is 2 edits off: it is repeated with one letter changed
    assert got == want | {0: (f"{line}\nnumber 0", 0), 20: ("", 1), 21: (None, 0), None: ("", 1)}
