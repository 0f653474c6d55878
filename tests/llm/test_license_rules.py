"""License rules: one text that holds and one that does not for every family; suppression against brute force."""

import random

import numpy as np
import pytest

from hebdo.llm import licenses
from hebdo.llm.license_rules import RULES, SPDX, expanded


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner()


def labels(scanner, text):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return {d["label"] for d in scanner.scan(data, np.array([0, len(data)]))[0]["found"]}


@pytest.mark.parametrize("text,want", [
    # SPDX expressions: every term counts
    ("SPDX-License-Identifier: MIT OR Apache-2.0", {"mit", "apache-2"}),
    ("// SPDX-License-Identifier: (GPL-2.0-or-later AND BSD-3-Clause)", {"gpl-2", "bsd-3-clause"}),
    ("SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception\nint main", {"apache-2", "llvm-exception"}),
    ("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0", {"gpl-2", "classpath-exception"}),
    ('license = "MIT OR Apache-2.0"', {"mit", "apache-2"}), ("SPDX-License-Identifier: Elastic-2.0", {"elastic"}),
    ("SPDX-License-Identifier: MIT and more words", {"mit"}),
    # identifiers that stand alone
    ("GPLv2+", {"gpl-2"}), ("BSD-3-Clause", {"bsd-3-clause"}), ("BSL-1.0", {"boost"}), ("PSF-2.0", {"python-2"}),
    ("LGPL-2.1", {"lgpl-2"}), ("EPL-2.0", {"epl"}), ("SSPL", {"sspl"}), ("BUSL-1.1", {"business-source"}),
    ("CC BY 4.0", {"cc-by"}), ("CC-BY-SA", {"cc-by-sa"}), ("Apache-2.0", {"apache-2"}),
    # grants, titles and fields of names that are plain words as well
    ("released under the MIT license", {"mit"}), ("licensed under MIT", {"mit"}), ("License: MIT", {"mit"}),
    ("The ISC License", {"isc"}), ("the Ruby license", {"ruby"}), ("PostgreSQL License", {"postgresql"}),
    ("under the OpenSSL license", {"openssl"}), ("the Vim license", {"vim"}), ("Elastic License 2.0", {"elastic"}),
    ("Server Side Public License", {"sspl"}), ("Business Source License 1.1", {"business-source"}),
    ("Blue Oak Model License 1.0.0", {"blue-oak"}), ("under the terms of the Artistic License", {"artistic"}),
    ("under the same terms as Perl itself", {"perl"}), ("Licensed under the zlib license", {"zlib"}),
    # clauses
    ("Redistributions of source code must retain the above copyright notice, this list", {"bsd"}),
    ("Neither the name of the University nor the names of its contributors may be used to endorse", {"bsd-3-clause"}),
    ("All advertising materials mentioning features or use of this software must display the following "
     "acknowledgement", {"bsd-4-clause"}),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is "
     "distributed on an \"AS IS\" BASIS", {"apache-2"}),
    ("provided \"as is\", without warranty of any kind", {"warranty-disclaimer"}),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial portions "
     "of the Software.", {"mit"}),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", {"mpl-2"}),
    ("This product includes software developed by the OpenSSL Project for use in the OpenSSL Toolkit", {"openssl"}),
    # addresses
    ("https://opensource.org/licenses/MIT", {"mit"}), ("http://www.apache.org/licenses/LICENSE-2.0", {"apache-2"}),
    ("https://creativecommons.org/licenses/by-nc-sa/4.0/", {"cc-by-nc-sa"}),
    ("https://www.gnu.org/licenses/gpl-3.0.html", {"gpl-3"}),
    ("https://creativecommons.org/publicdomain/zero/1.0/", {"cc0"}),
    # content and data
    ("Creative Commons Attribution-ShareAlike 4.0 International License", {"cc-by-sa"}),
    ("Open Government Licence v3.0", {"ogl"}), ("SIL Open Font License, Version 1.1", {"ofl"}),
    ("Llama 3 Community License Agreement", {"llama"}), ("All rights reserved.", {"all-rights-reserved"}),
])
def test_texts_that_state_a_license(scanner, text, want):
    assert labels(scanner, text) == want


@pytest.mark.parametrize("text", [
    "he worked under MIT supervision", "pilots came under Apache fire", "under Ruby lights", "under boost conditions",
    "driver license artistic studio", "an artistic license was taken by the poet", "she works at MIT", "vim is an editor",
    "the elastic band", "our business source said", "server side code", "python and php developers", "perl itself",
    "put me in cc by mistake", "the general public", "a library for the public", "eclipse of the sun", "blue oak table",
    "the ISC meeting", "released under embargo", "license plate", "licensed driver", "apache helicopters, 2 of them",
    "SPDX identifier", "the open software conference", "neither the name nor the date", "warranty of a car",
    "the font is open", "common development", "gnu and gnome", "mit der Zeit", "epl match day"])
def test_texts_that_state_none(scanner, text):
    assert labels(scanner, text) == set()


def test_the_pack_is_written_out():
    assert len(RULES) >= 200 and len({p for _, _, _, p in RULES}) == len(RULES)
    assert all(0 < priority < 100 and keys for _, priority, keys, _ in RULES)
    assert all("{" not in expanded(p).replace("{0,", "").replace("{1,", "") for _, _, _, p in RULES)


def test_every_spdx_term_is_found_by_itself(scanner):
    for term, label in SPDX.items():
        assert labels(scanner, f"SPDX-License-Identifier: {term}") == {label}, term


def test_suppression_equals_brute_force():
    rng = random.Random(4)
    for _ in range(300):
        found = []
        for _ in range(rng.randint(0, 40)):
            a = rng.randint(0, 30)
            found.append((rng.choice([40, 60, 80]), a, a + rng.randint(1, 12), rng.choice("abc")))
        kept = []
        for d in sorted(found, key=lambda d: (-d[0], d[1] - d[2], d[1], d[3])):
            if not any(k[1] <= d[1] and d[2] <= k[2] for k in kept):
                kept.append(d)
        assert licenses.suppressed(found) == kept


def test_base_phrases_are_compared_by_their_bytes(scanner):
    text = "under the mit license; Under THE Mit, License. under the mit licence"
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    got = scanner.scan(data, np.array([0, len(data)]))[0]
    assert got["places"] == [(0, "mit"), (4, "mit")]
