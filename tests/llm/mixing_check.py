"""Words a mix takes from each source against the targets."""

from brute import WORD
from test_text_operators import targets


def check(before, after):
    def words(df):
        out = {}
        for r in df.collect():
            out[r.source] = out.get(r.source, 0) + len(WORD.findall(r.text or ""))
        return out

    want = targets(words(before))
    got = words(after)
    assert all(abs(got.get(k, 0) - v) <= 1 for k, v in want.items())
