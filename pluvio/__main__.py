"""``python -m pluvio STEP --option value ...``: a step of the chain; its options are the step's parameters."""

from __future__ import annotations

import argparse
import inspect
import json
import sys
import typing

from .plans.steps import STEPS
from .session import build


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pluvio", description=__doc__)
    sub = top.add_subparsers(dest="step", required=True)
    for name, f in STEPS.items():
        p, kinds = sub.add_parser(name), typing.get_type_hints(f)
        for k, param in list(inspect.signature(f).parameters.items())[1:]:
            flag, kind, needed = "--" + k.replace("_", "-"), kinds[k], param.default is inspect.Parameter.empty
            plain = next((t for t in (typing.get_args(kind) or (kind,)) if t is not type(None)), str)
            if plain is bool:
                p.add_argument(flag, action=argparse.BooleanOptionalAction, default=param.default)
            elif typing.get_origin(plain) is list:
                p.add_argument(flag, type=int, nargs="*", default=None)
            else:
                p.add_argument(flag, type=plain, required=needed, default=None if needed else param.default)
    return top


def main(argv: list[str] | None = None) -> int:
    options = vars(parser().parse_args(argv))
    step = options.pop("step")
    spark = build(f"pluvio {step}")
    print(json.dumps(STEPS[step](spark, **options), sort_keys=True))
    return 0


if __name__ == "__main__":
    sys.exit(main())
