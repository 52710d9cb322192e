"""DataFrame-in / DataFrame-out billing operators."""
