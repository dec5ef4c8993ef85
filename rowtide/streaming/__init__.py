"""Structured Streaming form of the destination: packets in, versioned table snapshots out."""
