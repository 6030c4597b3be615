"""Sources and sinks: daily CSV drops, the lineitem adapter, fingerprints, run-tagged tables."""
