"""Sources and sinks: files, ledger, gold labels, cache, batch requests."""
