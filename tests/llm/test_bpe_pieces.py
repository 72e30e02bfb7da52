"""What the encoder does once for a piece and once for a text."""

import gc
import random
import weakref

from tallyhouse.llm import bpe


def test_known_pieces_are_only_looked_up(monkeypatch):
    own = bpe.Encoder(bpe.read_ranks())
    texts = ["the thonerea thonerea, anblewh!! thonerea", "anblewh thonerea!!"]
    first = [bpe.encode_digests(t, own) for t in texts]
    assert [own.decode(ids) for ids, _, _ in first] == [t.encode() for t in texts]
    monkeypatch.setattr(own, "encode_piece", lambda piece: 1 / 0)
    assert [bpe.encode_digests(t, own) for t in texts] == first


def test_short_pieces_search_only_the_places_reached(monkeypatch):
    own, rng = bpe.encoder(), random.Random(11)
    pieces = ["".join(rng.choices("aehinorst", k=rng.randrange(1, 60))) for _ in range(400)] + ["漢字🙂é".encode().decode("latin-1")]
    found = [own.encode_piece(p) for p in pieces]
    monkeypatch.setattr(bpe, "_CACHED_LENGTH", 0)
    assert found == [own.encode_piece(p) for p in pieces]
    monkeypatch.undo()
    # All places of a short piece were searched before.
    monkeypatch.setattr(bpe.Encoder, "_longest", lambda *_: 1 / 0, raising=False)
    monkeypatch.setattr(own, "pairs", {})
    assert found == [own.encode_piece(p) for p in pieces]


def test_runs_of_ids_give_the_same_digests(monkeypatch):
    text = "some words, 漢字 and the others " * 50
    want = bpe.encode_digests(text, bpe.encoder())
    monkeypatch.setattr(bpe, "_RUN", 7)
    assert bpe.encode_digests(text, bpe.encoder()) == want


def test_a_dropped_encoder_is_freed_at_once():
    own = bpe.Encoder({bytes([i]): i for i in range(256)})
    bpe.encode_digests("some text", own)
    gone = weakref.ref(own)
    gc.disable()
    try:
        del own
        assert gone() is None
    finally:
        gc.enable()
