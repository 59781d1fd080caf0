"""millrun — a layered real-time warehouse for factory equipment logs and
quality inspections, written as plain PySpark DataFrame functions.

Layers: ODS (raw JSON text) -> DWD/DIM (parsed, routed, upserted) ->
DWM (new-part flags, unique parts, wide inspection rows) -> DWS
(windowed roll-ups). Every operator is a ``DataFrame -> DataFrame``
function usable with ``df.transform``; the streaming drivers in
``millrun.streaming`` call the same functions on micro-batches.
"""

from millrun.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
