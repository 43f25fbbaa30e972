"""DataFrame operators; a fitted one is `fit_*(df) -> state` plus `apply_*(df, state)`."""
