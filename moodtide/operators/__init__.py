"""DataFrame transformations: lazy, caller owns the session, nothing is collected."""
