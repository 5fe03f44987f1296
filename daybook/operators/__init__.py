"""DataFrame-to-DataFrame operators and table maintenance."""
