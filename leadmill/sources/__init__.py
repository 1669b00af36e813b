"""Reading listings, wrapping them as raw rows, and the stored layers."""
