"""Structured Streaming form of the batch scan: batch files arriving over time.

The reference pipeline is batch-only; this module adds no new operator. It runs
the same labelling, group split and class-count operators on a file stream, so a
landing folder of batch files can be summarised incrementally.
"""

from skewscope.streaming.batches import running_balance, stream_batches, write_balance

__all__ = ["running_balance", "stream_batches", "write_balance"]
