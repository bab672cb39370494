import numpy as np

from tessera.llm import idcoder, tokenfiles


def test_a_segment_is_coded_in_many_lanes():
    # a step costs the same array calls however few its lanes are
    assert tokenfiles.SEGMENT // idcoder.BLOCK >= 2048
    ids = np.random.default_rng(3).integers(0, 500, 5 * idcoder.BLOCK + 3)
    blocks = idcoder.encode(ids)
    assert len(blocks) == 6
    assert (idcoder.decode(blocks) == ids).all()
