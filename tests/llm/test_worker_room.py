"""Workers outlive their tasks: what one module keeps there goes when a task of another begins."""

from __future__ import annotations

from zonecast.llm import common, op02_sentencepiece, op03_toxicity, op07_minmax


def test_a_task_drops_what_other_modules_keep():
    caches = [m for m in (op02_sentencepiece._coders, op03_toxicity._matchers, op07_minmax._word_cache)]
    saved = [dict(c) for c in caches]
    try:
        for c in caches:
            c.clear()
            c["kept"] = object()
        model = op03_toxicity.ToxicModel(base=0.5)
        assert list(common._with_room(op03_toxicity._feature_rows(model))(iter([]))) == []
        assert not op02_sentencepiece._coders and not op07_minmax._word_cache  # another module's
        assert len(op03_toxicity._matchers) >= 1  # its own
    finally:
        for c, old in zip(caches, saved, strict=True):
            c.clear()
            c.update(old)
