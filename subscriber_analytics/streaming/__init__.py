"""The continuous job: micro-batches to the event log and the score log."""
