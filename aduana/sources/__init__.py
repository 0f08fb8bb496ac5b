"""Reading landing files: listing, change detection, delimited scans, archives, the bridge."""
