"""DataFrame operators from source records to profiles."""
