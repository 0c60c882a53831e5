"""JSON documents in, related tables out, with a measure of how far to trust them."""
