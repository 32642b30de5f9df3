"""Source files that hold each case of the code chunkers once, for the queries that show them."""

SCRIPT = """\
import type { Ledger } from "./ledger";
import * as clock from "clock";
import defaults, { pick as choose } from "tools";

type Amount = number | bigint;

export interface Entry extends Dated {
  amount: Amount;
}

enum Side { In, Out }

export abstract class Book<T extends Entry> extends Shelf<T> implements Countable, Iterable<T> {
  total() { return this.rows.map((r) => weigh(r)).reduce(add, 0); }
}

const useTotals = (book: Book<Entry>) => {
  const memo = choose(book);
  return clock.now(memo?.total());
};

// one line of the book
export default function Line({ entry }: { entry: Entry }) {
  const shown = useTotals(entry.book);
  return <li onClick={() => mark(entry)}>{format`of ${shown}`}</li>;
}

export const round = async function (x: Amount) { return Math.round(Number(x)); };
let count = 0;

const adminApp = defaults();
const inner = tools.Router({ strict: true });
inner.delete("/entries/:id", (req, res) => drop(req.params.id).then(() => res.sendStatus(204)));
adminApp.put("/entries", guard, saveEntry);
plain.get("/nothing", saveEntry);

function saveEntry(req, res) {
  if (valid(req)) { store.put(new Entry(req.body)); }
}
"""

JAVA = """\
package org.ledger;

import java.time.Clock;
import java.util.*;
import static org.tools.Sums.add;

/** Money in and out. */
@RestController
public class Ledger extends Shelf<Entry> implements Countable, Iterable<Entry> {
    private final Clock clock = Clock.systemUTC();

    Ledger(Clock clock) { this.clock = check(clock); }

    /** All of it. */
    @PostMapping("/sum")
    public long sum(List<Entry> rows) {
        return rows.stream().map(e -> weigh(e)).reduce(0L, add(1));
    }

    private static void log(String s) { System.out.println(s.trim()); }
}

@Repository
interface Entries extends Store<Entry>, Countable {
    Entry byId(long id);
}

enum Side { IN, OUT }

record Pair(int left, int right) implements Countable {
    int both() { return left + right; }
}
"""

PYTHON = """\
import clock
import tools.sums as sums
from fastapi import APIRouter
from bottle import route
from django.db import models

api = APIRouter()


@api.get("/entries/{id}")
async def entry(id):
    \"\"\"One entry.\"\"\"
    return await find(id).first(weigh(id))


@route("/sum", method="POST")
def total():
    return sums.add(clock.now())


@require_http_methods(["PUT", "PATCH"])
def change(request):
    return save(request)


def _round(x):
    def inner(y):
        return floor(y)
    return inner(x)


class Entry(models.Model):
    amount = field(max(1, 2))


class EntryView(APIView, Countable):
    def get(self, request):
        return self.answer(load(request))

    def _key(self):
        return 1
"""

#: A file that no scanner finds a symbol in, and one that cannot be parsed as Python.
BARE, BROKEN = "export * from './book';\n", "def ok(x:\n    return call(x)\n\nclass Half:\n    y = (\n"
