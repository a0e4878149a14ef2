"""Rule data: fixed values the results depend on."""
