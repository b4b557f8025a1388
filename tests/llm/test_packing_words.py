"""What keeps packing cheap: words are looked up once each, and no collection runs over those held."""

import gc

from tapelake.llm import packing
from tapelake.llm.common import without_collections


def test_words_of_the_old_generation_are_kept_when_used():
    words = packing.Recent(1)
    assert words.missing({"a", "b"}) == {"a", "b"}
    words.now.update(a=1, b=2)
    words.turn()
    assert words.now == {} and words.missing({"a", "c"}) == {"c"} and words.now == {"a": 1}


def test_no_collections_while_batches_are_read_and_again_afterwards():
    @without_collections
    def run(batches):
        for batch in batches:
            yield batch, gc.isenabled()

    assert [*run(iter([1, 2]))] == [(1, False), (2, False)] and gc.isenabled()
    cut = run(iter([1, 2]))
    next(cut)
    cut.close()
    assert gc.isenabled()
