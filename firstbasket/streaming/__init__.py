"""Streaming operators: none.

The pipeline this package rebuilds is batch-only: loads are one-shot, there is no event-time
window, watermark, session or stateful operator, and the only "window" is the fixed per-person
repeat-purchase horizon, which is computed in batch by ``operators.cohort``. A scheduled batch
re-run over new data (with ``Config.dataset_end`` moved forward) covers the refresh use case, so
nothing is implemented here on purpose.
"""
