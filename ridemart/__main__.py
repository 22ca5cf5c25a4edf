"""``python -m ridemart --root <folder> [--stages ...]``: the full run."""

from ridemart.plans.jobs import main

if __name__ == "__main__":
    main()
