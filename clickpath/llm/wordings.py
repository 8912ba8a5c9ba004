"""Labelled wordings of licence notices: names, public notice texts, names outside the families, and ordinary uses of their words."""

from __future__ import annotations

import itertools
import random
import re

PUNCTUATION = ".,;:!?\"'()[]{}"
SEED = 20240229
CUTS = ((8, 2), (13, 3))  # (words, step) of the pieces of a notice text, as a narrow and a wide page wrap it
DROP = 0.08

# The names under which a family's notice refers to it, its SPDX identifiers, and its public notice text
FAMILIES = {
    "mit": (("MIT License", "MIT licence", "Expat License"), ("MIT",),
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
            "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
            "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
            "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
            "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
            "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
            "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
            "OTHER DEALINGS IN THE SOFTWARE."),
    "apache": (("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0 license", "ASL 2.0"), ("Apache-2.0",),
               "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
               "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
               "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
               "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
               "permissions and limitations under the License."),
    "gpl": (("GNU General Public License, version 3", "GNU General Public License, version 2", "GNU GPL v3", "GPLv3 license",
             "GNU Lesser General Public License", "GNU Affero General Public License"),
            ("GPL-3.0-or-later", "GPL-2.0-only", "LGPL-3.0-only", "AGPL-3.0-only"),
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
            "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
            "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
            "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have "
            "received a copy of the GNU General Public License along with this program."),
    "bsd": (("BSD 3-Clause License", "BSD 2-Clause License", "BSD License", "New BSD License"), ("BSD-3-Clause", "BSD-2-Clause"),
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
            "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
            "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
            "the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the "
            "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
            "without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND "
            "ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
            "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, "
            "INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"),
    "mozilla": (("Mozilla Public License, version 2.0", "Mozilla Public License", "MPL 2.0"), ("MPL-2.0",),
                "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "creative_commons": (("CC BY 4.0", "CC BY-NC 4.0", "CC BY-SA 4.0", "CC BY-NC-SA 4.0", "Creative Commons Attribution 4.0 International License",
                          "Creative Commons Attribution-ShareAlike License", "CC0 1.0 Universal"), ("CC-BY-4.0", "CC-BY-SA-4.0", "CC0-1.0"),
                         "This work is licensed under the Creative Commons Attribution 4.0 International License. To view a copy of this "
                         "license, visit http://creativecommons.org/licenses/by/4.0/ or send a letter to Creative Commons, PO Box 1866, "
                         "Mountain View, CA 94042, USA."),
    "proprietary": (("All rights reserved",), (),
                    "All rights reserved. No part of this publication may be reproduced, distributed, or transmitted in any form or by any "
                    "means, including photocopying, recording, or other electronic or mechanical methods, without the prior written "
                    "permission of the publisher."),
}
# Licences outside the families, and the frames of a notice
OTHER_NAMES = ("Eclipse Public License", "Eclipse Public License v2.0", "Artistic License 2.0", "zlib License", "Boost Software License",
               "ISC License", "The Unlicense", "Open Database License", "vendor software license", "Academic Free License",
               "university research license", "Open Font License", "European Union Public Licence", "Python Software Foundation License",
               "community source agreement", "public source agreement", "end user license agreement")
OTHER_IDS = ("EPL-2.0", "Zlib", "BSL-1.0", "ISC", "Artistic-2.0", "OFL-1.1", "EUPL-1.2")
FRAMES = ("{}", "the {}", "license: {}", "licensed under the {}", "licensed under {}", "released under the {}", "this work is licensed under the {}",
          "this work is licensed under {}", "this project is licensed under the {}", "distributed under the terms of the {}", "available under the {}",
          "see the {} for details", "copyright the authors licensed under the {}", "this file is covered by the {}")
BARE_FRAMES = ("{}", "copyright {}", "copyright the authors {}", "copyright (c) the authors {}", "{} worldwide")
HOLDERS = ("copyright {year} {name} corp {}", "copyright (c) {year} {name} inc. {}", "(c) {year} {name} ltd. {}", "© {year} {name} {}")
ID_FRAMES = ("SPDX-License-Identifier: {}", "# SPDX-License-Identifier: {}", "// SPDX-License-Identifier: {}",
             "/* SPDX-License-Identifier: {} */", "license: {}", "license = \"{}\"")

# Ordinary sentences with words of licence notices
ORDINARY = (
    "the driver lost a license after the accident", "the state issued a fishing license to the visitor", "she holds a driving licence",
    "students at mit built a small robot", "researchers from mit published a study", "the apache lived in the southwest",
    "an apache helicopter landed near the village", "the bsd conference took place in the spring", "the mozilla foundation hired new engineers",
    "copyright law protects the authors of books", "a copyright dispute went to court", "the table was reserved for two guests",
    "all seats are reserved for members", "all rights of the citizens were respected", "the museum reserved the right to close early",
    "creative people met in the commons", "the commons is a shared pasture", "the general public welcomed the decision",
    "software is distributed in many forms", "permission was granted to build the bridge", "the land was given to the farmers free of charge",
    "the publisher printed a second edition", "the work was published by the foundation", "a copy of the letter was found in the files",
    "the restaurant applied for a liquor license", "the pilot renewed a license", "the gnu migrates every year with the zebra",
    "children enter free of charge", "the eclipse was visible to the public", "licence fees pay for public television",
    "the band distributed copies of the record", "use of the source code is taught at school", "the conditions of the road were bad",
    "the court may be asked for written permission", "the university licensed the patent to a company", "no warranty covers this damage",
    "the terms of the agreement were announced on monday", "version 3 of the program was released in may", "the artist signed a public agreement",
)

# A corpus paragraph with one of these words is not used as an ordinary one
NOTICE_WORDS = ("license", "licence", "licensed", "licenses", "licences", "copyright", "reserved", "gplv3", "gpl", "cc", "warranty", "warranties",
                "redistribution", "redistributions", "spdx-license-identifier")

NONE, OTHER = "none", "other"
CLASSES = (NONE, OTHER, *FAMILIES)


def text_words(text: str) -> list[str]:
    """The words of ``licences.plain_words``, for the fixed texts."""
    return [w for w in (w.strip(PUNCTUATION) for w in text.lower().split()) if w]


def _pieces(text: str, rng: random.Random) -> list[str]:
    """The text whole, its sentences, and its pieces of each width, once as they are and once with words dropped."""
    w = text.split()
    out = [text, *text.split(". ")]
    for width, step in CUTS:
        for start in range(0, max(1, len(w) - width + 1), step):
            piece = w[start:start + width]
            out += [" ".join(piece), " ".join(x for x in piece if rng.random() >= DROP)]
    return out


def labelled_wordings() -> list[tuple[str, str]]:
    """(class, text): every frame with every name, identifiers, notice texts whole and in pieces, and ordinary sentences."""
    rng = random.Random(SEED)
    rows = [(NONE, text) for text in ORDINARY]
    for family, (names, ids, text) in FAMILIES.items():
        frames = BARE_FRAMES if family == "proprietary" else FRAMES
        rows += [(family, frame.format(name)) for frame, name in itertools.product(frames, names)]
        rows += [(family, frame.format(i)) for frame, i in itertools.product(ID_FRAMES, ids)]
        rows += [(family, piece) for piece in _pieces(text, rng)]
    for frame, i in itertools.product(HOLDERS, range(10)):
        rows.append(("proprietary", frame.format("all rights reserved", year=rng.randrange(1990, 2030), name=f"holder{i}")))
    rows += [(OTHER, frame.format(name)) for frame, name in itertools.product(FRAMES, OTHER_NAMES)]
    # both spellings of every name
    rows += [(label, re.sub("(?<=[Ll])icense", "icence", text)) for label, text in rows if label != NONE and len(text.split()) <= 12]
    rows += [(OTHER, frame.format(i)) for frame, i in itertools.product(ID_FRAMES, OTHER_IDS)]
    return rows


def notice_pairs(text: str) -> list[str]:
    """Neighbouring words of a notice text."""
    w = text_words(text)
    return [f"{a} {b}" for a, b in zip(w, w[1:])]


def reference_words(family: str) -> list[list[str]]:
    """The texts that a prediction of the family is compared with, as word lists: names, identifiers and the notice."""
    names, ids, text = FAMILIES[family]
    return [[w.replace("licence", "license") for w in text_words(t)] for t in (*names, *(ID_FRAMES[0].format(i) for i in ids), text)]
