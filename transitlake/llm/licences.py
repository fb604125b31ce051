"""Training texts of the licence scan: notices and paragraphs by licence family.

All of it is public wording. The set is bounded and does not depend on the corpus.
"""

from __future__ import annotations

NONE, UNKNOWN = "none", "unknown"

# Usual notices and paragraphs of public licences by family, licences of
# no family (``unknown``), and sentences with the same words that license nothing.
NOTICES: dict[str, tuple[str, ...]] = {
    "apache": (
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the Apache License",
        "SPDX-License-Identifier: Apache-2.0",
        "This project is released under the Apache License 2.0",
        "distributed under the terms of the Apache License version 2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.",
        "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable (except as stated in this section) patent license to make, have made, use, offer to sell, sell, import, and otherwise transfer the Work",
        "You must cause any modified files to carry prominent notices stating that You changed the files; and You must retain, in the Source form of any Derivative Works that You distribute, all copyright, patent, trademark, and attribution notices from the Source form of the Work",
    ),
    "mit": (
        "Released under the MIT License",
        "Licensed under the MIT license",
        "SPDX-License-Identifier: MIT",
        "This software is distributed under the MIT License",
        "The MIT License (MIT)",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "isc": (
        "Released under the ISC License",
        "Licensed under the ISC license",
        "SPDX-License-Identifier: ISC",
        "ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License",
        "Released under the BSD license",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Use of this source code is governed by a BSD-style license",
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU GPL v2",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "released under the GNU General Public License version 2",
        "This program is distributed under the GPL",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
        "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
        "You may convey a work based on the Program, or the modifications to produce it from the Program, in the form of source code under the terms of section 4, provided that you also meet all of these conditions",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1",
        "under the terms of the GNU Lesser General Public License version 2.1",
        "This library is released under the LGPL",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY. See the GNU Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library; if not, write to the Free Software Foundation",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
        "This program is released under the AGPL v3",
        "under the terms of the GNU Affero General Public License version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
        "if you modify the Program, your modified version must prominently offer all users interacting with it remotely through a computer network an opportunity to receive the Corresponding Source of your version",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License 2.0",
        "SPDX-License-Identifier: MPL-2.0",
        "released under the MPL 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "All distribution of Covered Software in Source Code Form, including any Modifications that You create or to which You contribute, must be under the terms of this License.",
    ),
    "epl": (
        "Licensed under the Eclipse Public License",
        "SPDX-License-Identifier: EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0 which is available at http://www.eclipse.org/legal/epl-2.0",
        "released under the Eclipse Public License 1.0",
        "The accompanying program is provided under the terms of this Eclipse Public License. Any use, reproduction or distribution of the Program constitutes Recipient's acceptance of this Agreement.",
    ),
    "eupl": (
        "Licensed under the EUPL",
        "SPDX-License-Identifier: EUPL-1.2",
        "Licensed under the European Union Public Licence version 1.2",
        "Licensed under the EUPL, Version 1.2 or as soon they will be approved by the European Commission subsequent versions of the EUPL (the \"Licence\"); You may not use this work except in compliance with the Licence.",
    ),
    "boost": (
        "Distributed under the Boost Software License, Version 1.0",
        "SPDX-License-Identifier: BSL-1.0",
        "Licensed under the Boost Software License",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software",
        "The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.",
    ),
    "zlib": (
        "Licensed under the zlib License",
        "SPDX-License-Identifier: Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
        "The origin of this software must not be misrepresented; you must not claim that you wrote the original software. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "SPDX-License-Identifier: CC-BY-4.0",
        "available under the Creative Commons Attribution License",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 License",
        "SPDX-License-Identifier: CC-BY-SA-3.0",
        "text is available under the Creative Commons Attribution-ShareAlike License",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 License",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
        "available under the Creative Commons Attribution-NonCommercial License",
    ),
    "public-domain": (
        "This work is dedicated to the public domain",
        "To the extent possible under law the author has waived all copyright under CC0 1.0",
        "SPDX-License-Identifier: CC0-1.0",
        "This is free and unencumbered software released into the public domain",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
        "the author has dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright 2020 The Company. All rights reserved.",
        "Unauthorized copying of this file is strictly prohibited",
        "Proprietary and confidential",
        "No part of this publication may be reproduced without prior written permission of the publisher",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means, including photocopying, recording, or other electronic or mechanical methods, without the prior written permission of the publisher",
        "This software contains confidential and proprietary information and may not be disclosed, copied or used without a written agreement with the company",
    ),
    UNKNOWN: (
        "Licensed under the Artistic License 2.0",
        "SPDX-License-Identifier: Artistic-2.0",
        "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE",
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.",
        "This Font Software is licensed under the SIL Open Font License, Version 1.1.",
        "The contents of this file are subject to the terms of the Common Development and Distribution License (the License). You may not use this file except in compliance with the License.",
        "Released under the Python Software Foundation License",
        "Licensed under the Academic Free License version 3.0",
        "Licensed under the Open Software License",
        "SPDX-License-Identifier: OFL-1.1",
        "released under the Foo Public License 1.0",
        "Licensed under the terms of the Sample Source License",
        "The licensee may install and use one copy of the product under this license agreement and may not rent, lease or sublicense it.",
        "This data is made available under the Open Database License; any rights in individual contents are licensed under the Database Contents License.",
    ),
    NONE: (
        "the driver lost the license of the car",
        "the license plate of the car was not visible",
        "the public was granted a copy of the terms",
        "the general of the army made a public statement on the version of events",
        "the work is under way and the people are free to use this road",
        "the rights of the people are reserved for another day",
        "the library is open to any person with a card",
        "version 2.0 of the file was released under the old name",
        "permission to use the source was given by the creative director",
        "all the software of the company is free of charge",
        "the terms of the contract may be subject to law",
        "er geht mit ihr und mit allen",
        "sie kam mit der bahn, er mit dem rad",
        "mit oder ohne",
        "students of mit and of apache county met under the bridge",
        "the common attribution of the painting is of the international school",
        "the domain of this function is the set of all numbers",
        "a court ruled that the damages arising from the accident were the liability of the driver and not of the company",
        "the warranty of the washing machine covers two years, including parts and other services",
        "the software reads the source files, copies the data and writes a binary file with a list of names",
        "copyright law was changed by parliament, and authors and publishers discussed the notice for months",
        "to install the program, download the source code, compile it and copy the files to a folder of your choice",
        "the authors of the study thank the holders of the data for their permission and the contributors for their work",
        "she obtained a driving license in the state and a copy of her certificate from the office",
        "the union and the commission agreed on a version of the treaty for public services",
        "an eclipse of the sun will be visible to the public, and the use of special glasses is required",
        "the event was free, any person could attend, and the conditions on the road were fair",
        "customers may use the network for commercial purposes provided that the fee is paid",
        "the patent office granted the company a patent for the machine in 1990",
        "a dedicated teacher, and to a lesser degree an artistic one",
        "see chapter 1.2 and chapter 2.1, figure 3.0 and table 4.0",
        "a boost for the economy of the state",
        "the european union",
        "a european database",
        "open to the general public",
        "a clause in the contract",
        "an eclipse, a mozilla and an apache",
        "the universal dedication of the commons",
        "a licence for the pub",
        "sa femme et sa maison",
        "sa",
        "a sample of the data",
        "version 3 or later of the file, version 2 and version 2.1 before",
        "raleigh, nc is the capital of north carolina",
        "the license was lost",
        "the contract gives the player the rights to his name, and the club must carry the loss of profits",
    ),
}
# Names of the licences and usual forms of naming one.
NAMES: dict[str, tuple[str, ...]] = {
    "apache": ("Apache License 2.0", "Apache-2.0"),
    "mit": ("MIT License", "The MIT License", "MIT licence"),
    "isc": ("ISC License", "The ISC License"),
    "bsd": ("BSD License", "BSD-3-Clause", "2-Clause BSD License"),
    "gpl": ("GNU General Public License", "GNU GPL v3 or later", "GPL version 2"),
    "lgpl": ("GNU Lesser General Public License", "GNU LGPL v3", "LGPL version 2.1"),
    "agpl": ("GNU Affero General Public License", "GNU AGPL v3 or later", "AGPL version 3"),
    "mpl": ("Mozilla Public License 2.0", "MPL 2.0"),
    "epl": ("Eclipse Public License 2.0", "EPL 2.0"),
    "eupl": ("European Union Public Licence", "EUPL 1.2"),
    "boost": ("Boost Software License 1.0", "BSL-1.0"),
    "zlib": ("zlib License", "zlib/libpng License"),
    "cc-by": ("Creative Commons Attribution 4.0", "CC BY 4.0", "CC-BY"),
    "cc-by-sa": ("Creative Commons Attribution-ShareAlike 3.0", "CC BY-SA 3.0", "CC-BY-SA"),
    "cc-by-nc": ("Creative Commons Attribution-NonCommercial 4.0", "CC BY-NC 4.0", "CC-BY-NC"),
    "public-domain": ("CC0", "Unlicense", "CC0 1.0 Universal public domain dedication"),
    UNKNOWN: ("Sample Public License", "Artistic License", "Open Database License", "SIL Open Font License"),
}
FORMS = (
    "{}",
    "The {} applies, version 1.0",
    "this file is licensed under the {}",
    "source code available under the terms of the {}",
    "you can redistribute it under the {}",
    "The project is released under {}",
)
# Words that make no feature of their own.
STOP = frozenset(
    "a all and any are at be by for from in into is it may no not of on or the this to was "
    "were with you can that".split()
)
