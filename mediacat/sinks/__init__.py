"""Writers and keyed state."""
