"""Streaming: the analyses rebuilt here are batch only (the reference has no
stream, watermark or stateful workload), so this package holds no operators.
Batch operators accept any DataFrame, including one materialised from a
stream's sink table."""
