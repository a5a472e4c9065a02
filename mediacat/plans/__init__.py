"""Plans that combine operators: a work pass, the monitoring view, user requests."""
