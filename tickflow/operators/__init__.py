"""DataFrame operators over log rows, stored events and topic records."""
