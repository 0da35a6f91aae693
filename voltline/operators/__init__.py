"""DataFrame -> DataFrame steps of the load: parse, infer, align, dedupe, anti-join, append, ledger."""
