"""Where profiles, events and log rows come from."""
