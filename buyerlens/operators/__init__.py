"""DataFrame-to-DataFrame operators; unless noted they take static and streaming input alike."""
