"""Job-level plans: stage wiring, sinks, run log, load-type dispatch, query registry."""
