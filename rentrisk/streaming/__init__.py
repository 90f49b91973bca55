"""Structured Streaming entry points.

The reference reads only batch tables; its row-wise steps (trim, date repair,
age, amounts) are plain column expressions here, so they run unchanged on a
streaming DataFrame. The dense random id needs the whole table (a global order)
and stays in the batch flow.
"""

from rentrisk.streaming.clean_stream import typed_stream  # noqa: F401
