"""Structured Streaming forms of the order-dependent processes: the reasoning
/answer splitter over reply chunks (T1), the per-step metric accumulator (T2)
and bounded conversation memory (T3)."""
